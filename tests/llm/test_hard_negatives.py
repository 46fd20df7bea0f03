import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import hard_negatives as module
from stallbook.llm.hard_negatives import Codebooks, hard_negatives


def brute(rows, every=10):
    """All results by comparing every anchor with every row."""
    out = []
    own = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
           if i is not None and lab is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    for i, lab, v in own:
        if i % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in own if j != i), key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == lab][:5]:
            inside = [s for s in scored if s[2] != lab and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(i, p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(inside)]
    return sorted(out)


def corpus(seed, n=700):
    """Vectors around centres, a third of them copies of one vector; labels follow the centres but for noise."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(n):
        c = int(rng.integers(12))
        v = centres[c] + rng.normal(size=8) * 0.4
        if i % 3 == 0:
            v = centres[0] + (rng.normal(size=8) * 0.01 if i % 2 else 0)
        v = v / np.linalg.norm(v)
        rows.append((i - 50, int(c % 4 if rng.random() < 0.7 else rng.integers(4)), [float(x) for x in v.astype(np.float32)]))
    return rows


EDGES = [(None, 1, [0.1] * 8), (10_000, None, [0.1] * 8), (10_010, 1, None), (10_020, 1, [0.1] * 7 + [None]), (10_030, 1, [float("nan")] * 8),
         (10_040, 1, [0.1] * 7 + [float("inf")]), (10_050, 1, [0.1] * 7), (10_060, 1, []), (10_070, 99, [0.2] * 8), (10_080, 2, [0.0] * 8), (10_081, 2, [0.0] * 8),
         (20, 3, [0.5] + [0.0] * 7), (20, 3, [0.5] + [0.0] * 7)]


def frame(spark, rows, partitions=4):
    data = [(i, lab, v, 1, "x") for i, lab, v in rows]
    return spark.createDataFrame(data, "vec_id long, label int, embedding array<float>, cell int, shard string").repartition(partitions)


@pytest.mark.parametrize("seed, shard_rows, probe, block", [(1, 16_384, 2000, 500), (2, 50, 30, 7), (3, 16, 1, 3)])
def test_results_are_those_of_all_rows(spark, monkeypatch, seed, shard_rows, probe, block):
    monkeypatch.setattr(module, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(module, "PROBE", probe)
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "CELL_ROWS", 8)
    rows = corpus(seed) + EDGES
    got = sorted(tuple(r) for r in hard_negatives(frame(spark, rows), F.col("id") % 10 == 0).collect())
    assert got == brute(rows) and len(got) > 500


def test_few_rows(spark):
    rows = [(0, 1, [0.5] * 8), (1, 1, [0.4] * 8), (2, 2, [0.3] * 8)]
    got = [tuple(r) for r in hard_negatives(frame(spark, rows), F.col("id") % 10 == 0).collect()]
    assert got == brute(rows) != []
    assert hard_negatives(frame(spark, []), F.col("id") % 10 == 0).collect() == []
    alone = frame(spark, [(0, 1, [0.5] * 8), (1, 2, [0.5] * 8)])
    assert hard_negatives(alone, F.col("id") % 10 == 0).collect() == []


def test_heap_visits_all_cells_by_bound():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, 36)
    books = Codebooks(rng.normal(size=(6, 4)), rng.normal(size=(6, 4)), rng.random(6), rng.random(6), rows, np.zeros(36, int), np.ones(36, int))
    got = list(books.cells(rng.normal(size=8)))
    assert sorted(c for _, _, c in got) == np.flatnonzero(rows).tolist()
    assert [b for b, _, _ in got] == sorted((b for b, _, _ in got), reverse=True)


def test_pruned_cells_hold_no_result():
    """Bounds hold for all members, and tight clusters leave most cells unvisited."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 8)) * 100
    x = np.round(np.repeat(centres, 50, 0) + rng.normal(size=(400, 8)))
    words = [np.unique(np.round(c), axis=0) for c in (centres[:, :4], centres[:, 4:])]
    at = [module.nearest(p, w) for p, w in zip((x[:, :4], x[:, 4:]), words)]
    radius = [np.array([np.linalg.norm(p[a == k] - w[k], axis=1).max(initial=0) for k in range(8)]) for p, w, a in zip((x[:, :4], x[:, 4:]), words, at)]
    cell = at[0] * 8 + at[1]
    books = Codebooks(*words, *radius, np.bincount(cell, minlength=64), np.zeros(64, int), np.ones(64, int))
    anchor = x[0]
    scores = x @ anchor
    for most, least, c in books.cells(anchor):
        assert least <= scores[cell == c].min() and scores[cell == c].max() <= most
    visited = set(books.visits(anchor, int(np.sort(scores)[-10]), module.GREATEST, False)) | set(books.visits(anchor, int(np.sort(scores)[-10]), module.GREATEST, True))
    assert set(cell[scores >= np.sort(scores)[-10]]) <= visited and len(visited) < 6


def test_great_components_are_counted_exactly_or_refused(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [float(rng.randrange(1, 2**16)) for _ in range(8)]) for i in range(40)]
    got = sorted(tuple(r) for r in hard_negatives(frame(spark, rows), F.col("id") % 10 == 0).collect())
    assert got == brute(rows) and max(r[4] for r in got) > 2**48
    with pytest.raises(Exception, match="too great|64 bits"):
        hard_negatives(frame(spark, [(0, 1, [1e12] * 8)]), F.col("id") % 10 == 0).collect()
