"""Repair of conversation structure by Viterbi search with coalescing survivors.

A conversation should alternate: an optional system turn, then user and assistant turns in pairs.
Rows are blank, repeated or cut short, or have the wrong role; the cheapest edits (keep, rerole,
delete, insert) that give a legal sequence are wanted, of equally cheap ones the least in ASCII order.

1. Rows get their place in the conversation; a repeated row is one whose place is not the first of its
   role and text. Places are cut into chunks of CHUNK rows, so a conversation that holds a third of all
   rows is spread over tasks.
2. Per chunk and state at its start, a Viterbi search keeps one survivor per state at the end. Survivors
   are leaves of a tree of backpointers with reference counts: a branch without survivors goes at once,
   and as soon as all survivors share an ancestor, the edits up to it are emitted and forgotten. Equally
   cheap survivors are compared by all their edits that are not emitted yet. (Neither is the beginning
   of the other: the longer one would have more inserts and cost more. So what follows cannot turn the order.)
3. The same search runs over the chunks of a conversation, with a chunk's survivors as its steps.
4. Edits are applied chunk by chunk.

Cases: null roles and texts count as one space; a row with an empty role cannot be kept; rows without conversation id are one conversation of
their own; turns may be null (first), repeated or missing; rows of one turn are ordered by role and a
digest of the text; a conversation all of whose rows must go is repaired to an empty one; an empty table
gives no rows. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stallbook.llm.common import prepare, tidied
from stallbook.operators.hot import Sort, ranked
from stallbook.session import stage

CHUNK = 4096
WHITE = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
# What a turn's role begins with, and what its faults ask for.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, SHORT, GOES = range(3)
# States: nothing yet, after system, after user, after assistant. The first and the last may end a conversation.
EMPTY, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = 4
ROLES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
# From each state, the states that inserted turns lead to, and how many turns that takes.
INSERTS = {EMPTY: {0: 0, 2: 1, 3: 2}, AFTER_SYSTEM: {1: 0, 2: 1, 3: 2}, AFTER_USER: {2: 0, 3: 1}, AFTER_ASSISTANT: {3: 0, 2: 1}}
# What follows a state when a turn of each role is kept.
KEPT = {(EMPTY, SYSTEM): AFTER_SYSTEM, (AFTER_USER, ASSISTANT): AFTER_ASSISTANT} | {
    (state, USER): AFTER_USER for state in (EMPTY, AFTER_SYSTEM, AFTER_ASSISTANT)
}
# What follows when a turn takes the role that may come next.
NEXT = {EMPTY: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}

# What is still to pay from the first state is at most so much more than from the second: turns inserted to get
# there, a system turn deleted that can no longer be kept, or a pair inserted at the end.
_NO_MORE_THAN = {
    (EMPTY, AFTER_SYSTEM): 0, (EMPTY, AFTER_USER): INSERT, (EMPTY, AFTER_ASSISTANT): 0,
    (AFTER_SYSTEM, EMPTY): 2 * INSERT, (AFTER_SYSTEM, AFTER_USER): INSERT, (AFTER_SYSTEM, AFTER_ASSISTANT): 2 * INSERT,
    (AFTER_USER, EMPTY): INSERT + DELETE, (AFTER_USER, AFTER_SYSTEM): INSERT, (AFTER_USER, AFTER_ASSISTANT): INSERT,
    (AFTER_ASSISTANT, EMPTY): DELETE, (AFTER_ASSISTANT, AFTER_SYSTEM): 0, (AFTER_ASSISTANT, AFTER_USER): INSERT,
}

Steps = list[tuple[int, int, int, str]]  # from state, to state, cost, edits


def steps_of(kind: int, fault: int) -> Steps:
    """All ways past one row: turns inserted before it, then the row deleted, kept or reroled."""
    out = []
    for start, reached in INSERTS.items():
        for state, n in reached.items():
            before, cost = "I" * n, n * INSERT
            out.append((start, state, cost + DELETE, before + "D"))
            if fault == GOES:
                continue
            more = cost + (CUT_SHORT if fault == SHORT else 0)
            if (state, kind) in KEPT:
                out.append((start, KEPT[state, kind], more, before + "K"))
            out.append((start, NEXT[state], more + REROLE, before + "R"))
    return out


ROW_STEPS = [steps_of(kind, fault) for kind in range(4) for fault in range(3)]
# Turns inserted after the last row.
END_STEPS: Steps = [(s, t, n * INSERT, "I" * n) for s, reached in INSERTS.items() for t, n in reached.items()
                    if (s, t) == (EMPTY, EMPTY) or t == AFTER_ASSISTANT]


class _Node:
    """The edits of one step, after those of its parent; `held` counts the children and survivors that need it."""

    __slots__ = ("edits", "held", "parent", "state")

    def __init__(self, parent: _Node | None, state: int, edits: str):
        self.parent, self.state, self.edits, self.held = parent, state, edits, 1


class Survivors:
    """The cheapest edits to each state so far, as a tree of which the settled trunk is given out."""

    # Steps between two looks for a common ancestor.
    EVERY = 32

    def __init__(self, state: int):
        self.root = _Node(None, state, "")
        self.leaves: dict[int, tuple[int, _Node]] = {state: (0, self.root)}
        self.steps = 0

    def _path(self, node: _Node) -> list[_Node]:
        """The nodes after the root up to this one."""
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]

    def step(self, steps: Steps) -> list[_Node]:
        """Go on by one row (or chunk); returns the nodes that are settled now, oldest first."""
        best: dict[int, tuple[int, _Node, str]] = {}
        for start, end, cost, edits in steps:
            if start not in self.leaves:
                continue
            total, node = self.leaves[start][0] + cost, self.leaves[start][1]
            old = best.get(end)
            if old is None or total < old[0] or (total == old[0] and self._less(node, edits, *old[1:])):
                best[end] = (total, node, edits)
        # A state that another one beats whatever follows has no survivor.
        for a, b in _NO_MORE_THAN:
            if a in best and b in best and best[a][0] + _NO_MORE_THAN[a, b] < best[b][0]:
                del best[b]
        fresh = {}
        for end, (total, parent, edits) in best.items():
            fresh[end] = (total, _Node(parent, end, edits))
            parent.held += 1
        for _, node in self.leaves.values():
            self._release(node)
        self.leaves = fresh
        self.steps += 1
        return self._settled() if self.steps % self.EVERY == 0 else []

    def _less(self, a: _Node, more_a: str, b: _Node, more_b: str) -> bool:
        if a is b:
            return more_a < more_b
        return edits_of(self._path(a)) + more_a < edits_of(self._path(b)) + more_b

    def _release(self, node: _Node) -> None:
        node.held -= 1
        while not node.held and node.parent is not None:
            node = node.parent
            node.held -= 1

    def _settled(self) -> list[_Node]:
        """The trunk that all survivors share; it leaves the tree."""
        path, out = self._path(next(iter(self.leaves.values()))[1]), []
        while self.root.held == 1 and path and len(path) > len(out) + 1:
            out.append(path[len(out)])
            self.root = out[-1]
            self.root.parent = None
        return out

    def finish(self) -> dict[int, tuple[int, list[_Node]]]:
        """Per state its cost and the nodes that were not given out before."""
        return {state: (cost, self._path(node)) for state, (cost, node) in self.leaves.items()}


def edits_of(nodes: list[_Node]) -> str:
    return "".join([n.edits for n in nodes])


def chunk_survivors(codes: bytes, start: int) -> dict[int, tuple[int, str]]:
    """Per state after the chunk: cost and edits of the cheapest way from the start state."""
    search, settled = Survivors(start), []
    for code in codes:
        settled.append(edits_of(search.step(ROW_STEPS[code])))
    head = "".join(settled)
    return {state: (cost, head + edits_of(rest)) for state, (cost, rest) in search.finish().items()}


def _text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def placed_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest, place, chunk): rows with their place in the conversation, from 0."""
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _text_of(role).alias("role"), _text_of(text).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.concat_ws("\x00", F.hex("role"), F.hex("text")), 256))
    order = [Sort("turn"), Sort("role"), Sort("digest")]
    ordered = ranked(rows, ["conv"], order, "place").withColumn("place", F.col("place") - 1)
    return stage(ordered.withColumn("chunk", F.floor(F.col("place") / CHUNK).cast("long")), "placed-turns")


def coded_turns(turns: DataFrame) -> DataFrame:
    """(conv, chunk, place, turn, kind, fault, code): what each row is and what its first fault is.

    fault: 0 none, 1 cut short, 2 blank, 3 repeated; code: kind and what the fault asks for.
    """
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    often = turns.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = often.select(F.col("conv").alias("conv2"), F.col("digest").alias("digest2"), "first")
    narrow = turns.select(
        "conv", "chunk", "place", "turn", "digest",
        F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in ("s", SYSTEM, "u", USER, "a", ASSISTANT)]), F.substring("role", 1, 1)), F.lit(OTHER)).alias("kind"),
        (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(ENDS)).alias("short"),
    )
    joined = narrow.join(again, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("digest") == F.col("digest2")), "left")
    fault = F.when(F.col("blank"), 2).when(F.col("place") > F.col("first"), 3).when(F.col("short"), 1).otherwise(0)
    rows = joined.withColumn("fault", fault)
    need = F.when(F.col("fault") >= 2, GOES).otherwise(F.col("fault"))
    return rows.select("conv", "chunk", "place", "turn", "kind", "fault", (F.col("kind") * 3 + need).alias("code"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key values, rows) of neighbouring rows with equal keys; a long run may come in several pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        own = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        start = 0
        for i in range(1, len(own) + 1):
            if i == len(own) or own[i] != own[start]:
                yield own[start], batch.slice(start, i - start)
                start = i


def schema_of(rows: DataFrame, more: str) -> T.StructType:
    """The type of `conv` with more columns."""
    return T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T._parse_datatype_string(more).fields])


def batch_of(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], to_arrow_schema(schema))


CHUNK_ROWS = ("chunk long, blank long, repeated long, short long, illegal long, first int, last int, low long, high long, turns long, "
              "costs array<long>, edits array<string>")
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_REMEMBERED = 50_000


def chunk_table(coded: DataFrame) -> DataFrame:
    """One row per (conv, chunk): counts of faults, its ends, and for each pair of states the cheapest edits between them."""
    schema = schema_of(coded, CHUNK_ROWS)

    def work(batches):
        known: dict[tuple[bytes, int], dict[int, tuple[int, str]]] = {}
        held: list[tuple] = []

        def survivors(codes: bytes, start: int):
            if (codes, start) not in known:
                if len(known) >= _REMEMBERED:
                    known.clear()
                known[codes, start] = chunk_survivors(codes, start)
            return known[codes, start]

        def summary(key):
            kinds, faults, codes, given = (np.concatenate([x[i] for x in held]) for i in range(4))
            pairs = list(zip(kinds[:-1].tolist(), kinds[1:].tolist()))
            costs, edits = [-1] * STATES * STATES, [""] * STATES * STATES
            for start in range(STATES) if key[1] else [EMPTY]:
                for end, (cost, own) in survivors(codes.astype(np.uint8).tobytes(), start).items():
                    costs[start * STATES + end], edits[start * STATES + end] = cost, own
            ends = [int(given[0]), int(given[-1]), int((np.diff(given) != 0).sum()) + 1] if len(given) else [None, None, 0]
            return (*key, int((faults == 2).sum()), int((faults == 3).sum()), int((faults == 1).sum()),
                    sum(p not in LEGAL for p in pairs), int(kinds[0]), int(kinds[-1]), *ends, costs, edits)

        last, out = None, []
        for key, rows in runs(batches, ["conv", "chunk"]):
            if last is not None and key != last:
                out.append(summary(last))
                held.clear()
                if len(out) == 500:
                    yield batch_of(out, schema)
                    out = []
            last = key
            held.append(tuple(rows.column(c).drop_null().to_numpy() for c in ("kind", "fault", "code", "turn")))
        if last is not None:
            out.append(summary(last))
            yield batch_of(out, schema)

    rows = coded.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place")
    return rows.mapInArrow(tidied(work), schema)




EDIT_ROWS = "chunk long, state int, edits string, gaps long, blank long, repeated long, short long, illegal long, cost long"
COUNTS = ["gaps", "blank", "repeated", "short", "illegal", "cost"]


class _Totals:
    """Counts of a conversation over its chunks, in order."""

    def __init__(self):
        self.blank = self.repeated = self.short = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, row: dict) -> None:
        if self.last is not None and (self.last, row["first"]) not in LEGAL:
            self.illegal += 1
        self.blank, self.repeated = self.blank + row["blank"], self.repeated + row["repeated"]
        self.short, self.illegal = self.short + row["short"], self.illegal + row["illegal"]
        self.last = row["last"]
        if row["turns"]:
            self.turns += row["turns"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def counts(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.repeated, self.short, self.illegal


def conversation_edits(chunks: DataFrame) -> DataFrame:
    """Per conversation its cheapest edits.

    Rows with a chunk number hold the state before the chunk and its edits (one more may hold inserts
    at the end); one row without holds the conversation's counts and cost.
    """
    schema = schema_of(chunks, EDIT_ROWS)

    def work(batches):
        out: list[tuple] = []
        conv, search, state, place, total = None, None, EMPTY, 0, _Totals()

        def emit(nodes: list[_Node]):
            nonlocal state, place
            for node in nodes:
                if node.edits:
                    out.append((conv, place, state, node.edits, *(None,) * len(COUNTS)))
                state, place = node.state, place + 1

        def ended():
            emit(search.step(END_STEPS))
            cost, rest = min(search.finish().values(), key=lambda x: (x[0], edits_of(x[1])))
            emit(rest)
            out.append((conv, None, None, None, *total.counts(), cost))

        for batch in batches:
            for row in batch.to_pylist():
                if search is None or row["conv"] != conv:
                    if search is not None:
                        ended()
                    conv, search, state, place, total = row["conv"], Survivors(EMPTY), EMPTY, 0, _Totals()
                total.add(row)
                emit(search.step([(i // STATES, i % STATES, c, e) for i, (c, e) in enumerate(zip(row["costs"], row["edits"])) if c >= 0]))
                if len(out) >= 500:
                    yield batch_of(out, schema)
                    out.clear()
        if search is not None:
            ended()
        if out:
            yield batch_of(out, schema)

    rows = chunks.repartition("conv").sortWithinPartitions("conv", "chunk")
    return rows.mapInArrow(tidied(work), schema)


def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, chunk, letter, role, text) for every edit in order, from turns with each chunk's edits before them."""
    conv, chunk, letters, state = None, None, iter(()), EMPTY
    for batch in batches:
        for row in batch.to_pylist():
            if row["edits"] is not None:
                for letter in letters:  # inserts after the last row
                    state = NEXT[state]
                    yield conv, chunk, letter, ROLES[state], ""
                conv, chunk, letters, state = row["conv"], row["chunk"], iter(row["edits"]), row["state"]
                continue
            for letter in letters:
                if letter == "I":
                    state = NEXT[state]
                    yield conv, chunk, letter, ROLES[state], ""
                    continue
                if letter == "D":
                    yield conv, chunk, letter, None, None
                elif letter == "R":
                    state = NEXT[state]
                    yield conv, chunk, letter, ROLES[state], row["text"]
                else:
                    state = KEPT[state, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[row["role"][0]]]
                    yield conv, chunk, letter, row["role"], row["text"]
                break
    for letter in letters:
        state = NEXT[state]
        yield conv, chunk, letter, ROLES[state], ""


def with_edits(turns: DataFrame, edits: DataFrame, *keys: str) -> DataFrame:
    """Turns in order, each chunk's edits before its rows; rows of equal keys are in one part."""
    pieces = edits.where("chunk IS NOT NULL").select("conv", "chunk", F.lit(-1).cast("long").alias("place"), "state", "edits", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = turns.select("conv", "chunk", "place", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("edits"), "role", "text")
    return pieces.unionByName(rows).repartition(*keys).sortWithinPartitions("conv", "chunk", "place")


def repaired_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, chunk, step, edit, role, text): the repaired conversations' turns, in order of chunk and step."""
    schema = schema_of(turns, "chunk long, step long, edit string, role string, text string")

    def work(batches):
        out, last, step = [], None, 0
        for conv, chunk, letter, role, text in applied(batches):
            step = step + 1 if (conv, chunk) == last else 0
            last = (conv, chunk)
            if letter != "D":
                out.append((conv, chunk, step, letter, role, text))
            if len(out) >= 500:
                yield batch_of(out, schema)
                out = []
        if out:
            yield batch_of(out, schema)

    return with_edits(turns, edits, "conv", "chunk").mapInArrow(tidied(work), schema)


def digests(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): all edits of a conversation and the hash of its repaired `role:text` lines.

    A hash takes its bytes one after the other, so a conversation passes through one task here, streamed.
    """
    schema = schema_of(turns, "audit string, repaired_sha256 string")

    def work(batches):
        out, conv, letters, hashed, lines = [], None, None, None, 0

        def ended():
            out.append((conv, "".join(letters), hashed.hexdigest()))

        for own, _, letter, role, text in applied(batches):
            if letters is None or own != conv:
                if letters is not None:
                    ended()
                    if len(out) >= 500:
                        yield batch_of(out, schema)
                        out.clear()
                conv, letters, hashed, lines = own, [], hashlib.sha256(), 0
            letters.append(letter)
            if letter != "D":
                hashed.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1
        if letters is not None:
            ended()
        if out:
            yield batch_of(out, schema)

    return with_edits(turns, edits, "conv").mapInArrow(tidied(work), schema)


class Repair(NamedTuple):
    """The steps of a repair, each a table: placed turns, edits by chunk, counts by conversation."""

    turns: DataFrame
    edits: DataFrame
    counts: DataFrame


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits of every conversation; `repaired_turns` and `digests` apply them."""
    prepare(conversations.sparkSession)
    turns = placed_turns(conversations, conv, turn, role, text)
    edits = stage(conversation_edits(stage(chunk_table(coded_turns(turns)), "chunk-survivors")), "conversation-edits")
    return Repair(turns, edits.where("chunk IS NOT NULL"), edits.where("chunk IS NULL").select("conv", *COUNTS))


def repair_report(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: its counts of faults and gaps, the cost, the edits and the digest of the repaired text."""
    done = repair(conversations, conv, turn, role, text)
    digest = digests(done.turns, done.edits).withColumnRenamed("conv", "conv2")
    rows = done.counts.join(digest, F.col("conv").eqNullSafe(F.col("conv2")))
    return rows.select(
        F.col("conv").alias(conv), "gaps", "blank", F.col("repeated").alias("duplicate"), F.col("short").alias("truncated"),
        "illegal", "cost", "audit", "repaired_sha256",
    )
