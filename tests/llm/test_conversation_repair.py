import hashlib
import itertools
import random
import re

import pytest

from stallbook.llm import conversation_repair
from stallbook.llm.conversation_repair import repair, repair_report, repaired_turns

LEGAL = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired lines) by trying all edits: every row kept, reroled or deleted, inserts in every gap."""
    best = None
    own = []
    for (_, role, text), fault in zip(rows, faults):
        more = 3 if fault == "truncated" else 0
        choices = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            choices += [("K", more, (role, text)), ("R", 3 + more, ("user", text)), ("R", 3 + more, ("assistant", text))]
        own.append(choices)
    inserts = [("", 0, []), ("I", 3, [("user", "")]), ("I", 3, [("assistant", "")]), ("II", 6, [("user", ""), ("assistant", "")]), ("II", 6, [("assistant", ""), ("user", "")])]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        if sum(g[1] for g in gaps) > 4 * len(rows):  # to delete all is cheaper
            continue
        for picks in itertools.product(*own):
            cost = sum(g[1] for g in gaps) + sum(p[1] for p in picks)
            if best and cost > best[0]:
                continue
            lines, audit = list(gaps[0][2]), gaps[0][0]
            for pick, gap in zip(picks, gaps[1:]):
                lines += ([pick[2]] if pick[2] else []) + gap[2]
                audit += pick[0] + gap[0]
            if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    def digest(r, x):
        return hashlib.sha256(f"{r.encode().hex().upper()}\x00{x.encode().hex().upper()}".encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
    faults = faults_of(rows)
    cost, audit, lines = cheapest(rows, faults)
    turns = [t for t, _, _ in rows if t is not None]
    heads = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{x}" for r, x in lines)
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def corpus(seed, n=60, most=4):
    rng, rows = random.Random(seed), {}
    for c in range(n):
        turn = 0
        rows[c] = []
        for _ in range(rng.randrange(1, most + 1)):
            turn += rng.choice([0, 1, 1, 1, 2, 5])
            rows[c].append((rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                            rng.choice(["One.", "Two!", "three", "x.  \n", "", " \t", None, "cut short"])))
    return rows


def frame(spark, by_conv, partitions=4):
    rows = [(c, t, r, x, "extra", 1) for c, own in by_conv.items() for t, r, x in own]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, chunk int").repartition(partitions)


@pytest.mark.parametrize("chunk, every", [(4096, 32), (1, 1), (2, 1)])
def test_edits_are_the_cheapest_of_all(spark, monkeypatch, chunk, every):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    monkeypatch.setattr(conversation_repair.Survivors, "EVERY", every)
    by_conv = corpus(chunk, 40 if chunk > 1 else 25)
    by_conv[-7] = [(1, "user", " ")]
    by_conv[None] = [(3, "user", "Without a conversation id."), (4, "assistant", "Yes.")]
    got = {r[0]: tuple(r)[1:] for r in repair_report(frame(spark, by_conv)).collect()}
    assert got == {c: expected(own) for c, own in by_conv.items()}


def whole(codes, state=0):
    """Survivors over all rows at once, in plain dynamic programming over (cost, edits)."""
    best = {state: (0, "")}
    for steps in [*(conversation_repair.ROW_STEPS[c] for c in codes), conversation_repair.END_STEPS]:
        new = {}
        for s, t, cost, edits in steps:
            if s in best:
                own = (best[s][0] + cost, best[s][1] + edits)
                new[t] = min(new.get(t, own), own)
        best = new
    return min(best.values())


@pytest.mark.parametrize("seed", range(6))
def test_settled_edits_and_the_rest_are_those_of_the_plain_search(seed):
    rng = random.Random(seed)
    codes = [rng.choice([3, 6, 3, 6, 0, 4, 7, 11, 9]) for _ in range(700)]
    search, edits, longest = conversation_repair.Survivors(0), "", 0
    for code in codes:
        edits += conversation_repair.edits_of(search.step(conversation_repair.ROW_STEPS[code]))
        longest = max(longest, max(len(search._path(n)) for _, n in search.leaves.values()))
    edits += conversation_repair.edits_of(search.step(conversation_repair.END_STEPS))
    cost, rest = min(search.finish().values(), key=lambda x: (x[0], conversation_repair.edits_of(x[1])))
    assert (cost, edits + conversation_repair.edits_of(rest)) == whole(codes)
    assert longest < 200  # the trunk was given out long before the end


def test_long_conversation_is_the_same_in_chunks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(t, rng.choice(["user", "assistant", "user", "assistant", "system"]), f"Text {t}" + rng.choice([".", "", "!"])) for t in range(900)]
    data = frame(spark, {1: rows, 2: rows[:3]}, 6)
    once = sorted(tuple(r) for r in repair_report(data).collect())
    monkeypatch.setattr(conversation_repair, "CHUNK", 64)
    assert sorted(tuple(r) for r in repair_report(data).collect()) == once
    done = repair(data)
    assert done.turns.groupBy("conv", "chunk").count().agg({"count": "max"}).first()[0] == 64
    lines = [r for r in repaired_turns(done.turns, done.edits).collect() if r.conv == 1]
    lines.sort(key=lambda r: (r.chunk, r.step))
    assert LEGAL.fullmatch("".join(r.role[0] for r in lines))
    assert hashlib.sha256("\n".join(f"{r.role}:{r['text']}" for r in lines).encode()).hexdigest() == once[0][-1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair_report(empty).collect() == []
