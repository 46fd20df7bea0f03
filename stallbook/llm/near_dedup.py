"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Every text's distinct five-word shingles give a class number (equal sets are one class) and
   a signature of COORDINATES MinHash values. Everything below is about classes.
2. Each class is posted under each (coordinate, value) of the first POSTED coordinates. Two
   texts that agree in at least `posted` of them share a value among the first
   POSTED - `posted` + 1 of each, in any one order of all values; with the rarest values
   first these prefixes hold few common values, and values with one posting need no list.
3. Lists are merged with skips. First every list pairs its members with one leader only; pairs
   whose signatures agree in `match` coordinates are confirmed on the full sets, and confirmed
   pairs are joined to components. Then only lists that still hold several components are gone
   through again, in blocks: pairs across components whose signatures agree in `match` coordinates
   are confirmed on the spot, and only links leave the task. So the pairs of a large group of
   copies, which change nothing, are never formed, while every pair that could still link two
   components is counted.
4. Components of all confirmed links; each text's component is the smallest id in it.

The similarity is a parameter, in per cent; both limits follow from it (`limits`). Chance to lose a
pair at exactly the threshold: at most 5 in 10,000 (about 4 at 0.85), falling fast above it.

Cases: null, empty and wordless texts have no shingles and link with nothing; a text of one to
four words is one shingle; a row without id is linked with nothing, has no component and is
kept; rows with one id are one document with several texts, linked through the id; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import (
    SPACED, distinct_per_row, mixed, pieces, prepare,
    shingles, split_words, texts_of, tidied, word_hashes,
)
from stallbook.session import stage

COORDINATES, POSTED = 256, 64
# Chances that the limits of posted and of all coordinates may lose a pair at exactly the threshold.
POSTED_LOSS, LOSS = 0.0003, 0.0002
# Text bytes whose shingles a task works on at a time.
PIECE_BYTES = 4_000_000
# Members of a list that are compared with each other in one go.
BLOCK = 512
# Ids of the texts to read again that are broadcast at most; beyond, the texts are joined by shuffle.
BROADCAST_IDS = 500_000

# Odd multipliers put the well-mixed shingle hashes into another order each.
MULTIPLIERS = np.random.default_rng(20_240_101).integers(1, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)


class Limits(NamedTuple):
    percent: int
    posted: int
    match: int


def limits(percent: int) -> Limits:
    """The similarity with the agreements, among the posted and among all coordinates, that the chances of loss allow to ask for."""

    def least(n: int, loss: float) -> int:
        share, below = percent / 100, 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * share**k * (1 - share) ** (n - k)
            if below > loss:
                return k
        return n

    return Limits(percent, least(POSTED, POSTED_LOSS), least(COORDINATES, LOSS))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, first of each text plus the end)."""
    codes, offsets, words = split_words(texts, SPACED)
    values, rows = distinct_per_row(*shingles(codes, offsets, word_hashes(words)))
    return values, np.searchsorted(rows, np.arange(len(texts) + 1))


def signatures(values: np.ndarray, starts: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    """Least hash of each text's shingles under each coordinate; the largest number for an empty set."""
    n = np.diff(starts)
    out = np.full((len(n), COORDINATES), np.iinfo(np.uint64).max, dtype=np.uint64)
    filled = np.flatnonzero(n)
    first = 0
    while first < len(filled):  # some tens of thousand shingles at a time stay in the processor's cache
        last = first + 1
        while last < len(filled) and starts[filled[last] + 1] - starts[filled[first]] <= step:
            last += 1
        rows = filled[first:last]
        own = values[starts[rows[0]] : starts[rows[-1] + 1]]
        heads = starts[rows] - starts[rows[0]]
        for c in range(COORDINATES):
            out[rows, c] = np.minimum.reduceat(own * MULTIPLIERS[c], heads)
        first = last
    return mixed(out)


def features(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key, row_hash, n (set size), cls (class number), posted (64-bit values), rest (8 bits of the other values, to count with)."""

    def build(batches):
        for batch in pieces(batches, most=PIECE_BYTES):
            values, starts = shingle_sets(texts_of(batch))
            sig = signatures(values, starts)
            cls = [xxhash.xxh64_intdigest(values[a:b].tobytes(), int(b - a)) for a, b in zip(starts[:-1], starts[1:])]
            place = np.arange(POSTED, dtype=np.uint64)
            posted = mixed(sig[:, :POSTED] + place).view(np.int64)
            rest = sig[:, POSTED:].astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(starts), pa.int64()),
                 pa.array(np.array(cls, dtype=np.uint64).view(np.int64), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * POSTED), pa.array(posted.ravel(), pa.int64())),
                 pa.array([r.tobytes() for r in rest], pa.binary())],
                names=["key", "row_hash", "n", "cls", "posted", "rest"])

    rows = documents.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("row_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(tidied(build), "key long, row_hash long, n long, cls long, posted array<long>, rest binary")


def prefix_postings(classes: DataFrame, limit: Limits) -> DataFrame:
    """(value, cls): each class under its rarest values, those only that another class has too."""
    postings = classes.select("cls", F.explode("posted").alias("value"))
    common = stage(postings.groupBy("value").agg(F.count("*").alias("times")).where("times > 1"), "common-values")
    shared = postings.join(common, "value")
    own = Window.partitionBy("cls")
    ranked = shared.select(
        "cls", "value", F.row_number().over(own.orderBy("times", "value")).alias("place"), F.count("*").over(own).alias("own")
    )
    # The values without a second posting are rarer: they come first and take POSTED - own places.
    return ranked.where(F.col("place") + POSTED - F.col("own") <= POSTED - limit.posted + 1).select("value", "cls")


def agreeing(rows: DataFrame, limit: Limits) -> DataFrame:
    """(a, b) of those pairs whose signatures agree enough: columns a, b, na, nb, posted_a, posted_b, rest_a, rest_b."""

    def check(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.stack([batch.column(i).to_numpy() for i in (2, 3)])
            posted = [batch.column(i).flatten().to_numpy().reshape(-1, POSTED) for i in (4, 5)]
            rest = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COORDINATES - POSTED) for i in (6, 7)]
            same = (posted[0] == posted[1]).sum(1) + (rest[0] == rest[1]).sum(1)
            keep = pa.array((same >= limit.match) & (100 * sizes.min(0) >= limit.percent * sizes.max(0)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return rows.mapInArrow(tidied(check), "a long, b long")


def beside(pairs: DataFrame, data: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with columns of both classes, as <column>_a and <column>_b."""
    for side in ("b", "a"):
        pairs = pairs.join(data.select(F.col("cls").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def confirmed(pairs: DataFrame, sets: DataFrame, limit: Limits) -> DataFrame:
    """Pairs whose full sets are as alike as asked for."""

    def check(batches):
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = pa.array([alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), limit.percent) for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    rows = beside(pairs, sets, ["shingles"]).select("a", "b", "shingles_a", "shingles_b")
    return rows.mapInArrow(tidied(check), "a long, b long")


def groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Runs of rows equal in the first `width` columns, from sorted batches; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(width)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if last is not None and tuple(keys[:, a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(keys[:, a])
    if held:
        yield pa.Table.from_batches(held)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets are as alike as asked for."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def cross_links(lists: DataFrame, limit: Limits) -> DataFrame:
    """(a, b): confirmed links across components, from (value, cls, comp, n, posted, rest, prefix, shingles).

    A list is cut into blocks of about BLOCK members; every two blocks meet in a task of their
    own. Of the lists that two classes share, only that of the least value takes them up, and
    pairs that links found before have joined are skipped. Only links leave a task.
    """
    sizes = lists.groupBy("value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = lists.join(stage(sizes, "list-sizes"), "value")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       "own", "cls", "comp", "n", "posted", "rest", "prefix", "shingles")

    def compare(batches):
        for group in groups(batches, 3):
            group = group.combine_chunks()
            own, cls, comp, n = (group.column(c).to_numpy() for c in ("own", "cls", "comp", "n"))
            comp = comp.copy()
            if len(np.unique(comp)) < 2:
                continue
            value, i, j = (group.column(c)[0].as_py() for c in ("value", "i", "j"))
            posted = group.column("posted").combine_chunks().flatten().to_numpy().reshape(-1, POSTED)
            rest = np.frombuffer(b"".join(group.column("rest").to_pylist()), np.uint8).reshape(-1, COORDINATES - POSTED)
            prefix = [set(p) for p in group.column("prefix").to_pylist()]
            shingles_of = group.column("shingles")
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            found = []
            for start in range(0, len(left), 32):
                rows = left[start : start + 32]
                same = (posted[rows][:, None] == posted[right][None]).sum(2) + (rest[rows][:, None] == rest[right][None]).sum(2)
                small, large = np.minimum(n[rows][:, None], n[right][None]), np.maximum(n[rows][:, None], n[right][None])
                ok = (same >= limit.match) & (comp[rows][:, None] != comp[right][None]) & (100 * small >= limit.percent * large)
                if i == j:
                    ok &= cls[rows][:, None] < cls[right][None]
                for x, y in zip(*np.nonzero(ok)):
                    x, y = rows[x], right[y]
                    if comp[x] == comp[y] or min(prefix[x] & prefix[y]) != value:
                        continue
                    if alike(*(np.frombuffer(shingles_of[int(k)].as_py(), np.uint64) for k in (x, y)), limit.percent):
                        found.append((cls[x], cls[y]))
                        comp[comp == comp[y]] = comp[x]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    sorted_rows = rows.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    return sorted_rows.mapInArrow(tidied(compare), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the nodes with edges (a, b): nodes of one component share comp.

    Each round hooks every node to its smallest neighbour, follows the hooks a few steps and
    contracts the edges; it ends when no edge joins two names. Written after each round.
    """
    current, names = stage(edges.where("a <> b").distinct(), "edges"), None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "hooks")
        jumped = parent
        for _ in range(2):
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = jumped.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        parent = stage(jumped, "hooks")
        if names is None:
            names = parent.select("node", F.col("up").alias("comp"))
        else:
            above = parent.select(F.col("node").alias("comp"), F.col("up").alias("top"))
            names = stage(names.join(above, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "names")
        for side in ("a", "b"):
            current = current.join(parent.select(F.col("node").alias(side), F.col("up").alias(f"{side}2")), side)
        current = stage(current.where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "edges")
    return names if names is not None else current.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def full_sets(documents: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(cls, shingles) of the wanted (cls, key, row_hash), from the texts themselves."""
    rows = documents.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("row_hash"), F.col(text).alias("text"))
    # The ids are broadcast only when they are few; else Spark joins by its own choice.
    chosen = rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, ["key", "row_hash"])

    def build(batches):
        for batch in pieces(batches, most=PIECE_BYTES):
            values, starts = shingle_sets(texts_of(batch))
            packed = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["cls", "shingles"])

    return chosen.select("cls", "text").mapInArrow(tidied(build), "cls long, shingles binary").dropDuplicates(["cls"])


def links(documents: DataFrame, classes: DataFrame, key: str, text: str, limit: Limits) -> DataFrame:
    """(a, b): confirmed links of classes; enough of them to join every pair that is alike."""
    postings = stage(prefix_postings(classes, limit), "postings")
    lists = postings.groupBy("value").agg(F.min("cls").alias("leader"), F.count("*").alias("times")).where("times > 1")
    lists = stage(lists, "lists")
    postings = stage(postings.join(lists.select("value", "leader"), "value"), "postings")
    in_play = stage(classes.join(postings.select("cls").distinct(), "cls", "left_semi"), "in-play")
    sets = stage(full_sets(documents, in_play.select("cls", "key", "row_hash"), key, text), "sets")
    sign = ["n", "posted", "rest"]
    ordered = ["a", "b", "n_a", "n_b", "posted_a", "posted_b", "rest_a", "rest_b"]

    led = postings.where("cls <> leader").select(F.col("leader").alias("a"), F.col("cls").alias("b")).distinct()
    first = stage(confirmed(agreeing(beside(led, in_play, sign).select(*ordered), limit), sets, limit), "links")

    names = components(first)
    named = postings.join(names.withColumnRenamed("node", "cls"), "cls", "left").select("value", "cls", F.coalesce("comp", "cls").alias("comp"))
    named = stage(named, "named-postings")
    open_lists = stage(named.groupBy("value").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
                       .where("low <> high").select("value"), "open-lists")
    prefixes = named.groupBy("cls").agg(F.collect_list("value").alias("prefix"))  # at most POSTED - limit.posted + 1
    data = in_play.select("cls", *sign).join(prefixes, "cls").join(sets, "cls")
    open_rows = named.join(open_lists, "value").join(data, "cls")
    return first.unionByName(stage(cross_links(open_rows, limit), "links"))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """Per document row: key, n_shingles, component_id, kept (it has its component's smallest id).

    Two texts are linked when their sets share at least `percent` in a hundred of their union.
    """
    prepare(documents.sparkSession)
    rows = stage(features(documents, key, text), "signatures")
    linked = rows.where("n > 0 AND key IS NOT NULL")
    classes = linked.dropDuplicates(["cls"])
    found = links(documents, classes, key, text, limits(percent))
    # An id with several texts joins their classes.
    ids = linked.select("key", "cls").distinct()
    least = ids.groupBy("key").agg(F.min("cls").alias("a"), F.count("*").alias("times")).where("times > 1")
    same_id = ids.join(least, "key").where("a <> cls").select("a", F.col("cls").alias("b"))
    names = components(found.unionByName(same_id)).withColumnRenamed("node", "cls")
    placed = linked.select("key", "cls").join(names, "cls", "left").select("key", F.coalesce("comp", "cls").alias("comp"))
    smallest = stage(placed.groupBy("comp").agg(F.min("key").alias("component_id")), "components")
    own = rows.select("key", "n", "cls").join(names, "cls", "left")
    own = own.select("key", "n", F.when((F.col("n") > 0) & F.col("key").isNotNull(), F.coalesce("comp", "cls")).alias("comp"))
    out = own.join(smallest, "comp", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
