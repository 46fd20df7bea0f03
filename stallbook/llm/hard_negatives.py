"""Hard negatives by an inverted multi-index with certified windows.

1. Vectors become whole numbers, floor(scale * x); a score is their inner product.
2. Two codebooks, one for each half of the components, are fitted by k-means in one task on a sample of
   at most SAMPLE_ROWS rows, those with the least hash. Every row is indexed: its cell is the pair of its
   nearest codewords, and each codeword keeps its radius, the farthest of all its rows' halves.
3. A row of cell (i, j) scores at most <a1, c1_i> + |a1| r1_i + <a2, c2_j> + |a2| r2_j for an anchor a. The
   multi-sequence heap visits cells by this sum, greatest first.
4. A search asks, per anchor, for the best rows whose scores lie in windows. Its first round visits
   cells of about PROBE rows and so learns what a window's last place must score at least. The second
   visits on to the cell whose bound is below that of every window: nothing left can get in, the
   windows are certified and the result is that of comparing with all rows.
5. Positives are the search of one open window among rows of the anchor's label; each of them then
   gives a window of scores in which the negatives are searched.

Cells are packed into shards of about SHARD_ROWS rows, a greater cell is dealt over several, and a shard
that many anchors ask for is met in several blocks; no task holds more than a shard and a few requests.

Cases: rows without id, label or vector, or with a component that is null or not finite, take no part,
nor do rows whose vector is not as long as most (of two lengths equally frequent, the shorter one);
rows of one id are rows of their own and no candidates for each other; equal scores are ordered by
id; a row without partners of its label has no result; an empty table gives no rows. Scores have to
fit into 64 bits: greater components make the job fail. Other columns play no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import prepare, tidied
from stallbook.session import stage

SAMPLE_ROWS = 20_000
# Rows of a cell on average, from which the number of codewords follows, and the most codewords of a half.
CELL_ROWS, MOST_WORDS = 200, 64
SHARD_ROWS = 16_384
PROBE = 2_000
# Requests that meet a shard in one task, and those that are compared with it in one go.
BLOCK, TOGETHER = 500, 32
LEAST, GREATEST = -(2**62), 2**62


class Codebooks(NamedTuple):
    """Codewords of both halves with their radii, and rows and first shard of each cell."""

    first: np.ndarray
    second: np.ndarray
    radius_first: np.ndarray
    radius_second: np.ndarray
    rows: np.ndarray
    shard: np.ndarray
    chunks: np.ndarray

    def cells(self, vector: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(most, least a row of the cell can score, cell) of the cells with rows, the greatest bound first."""
        half, k = self.first.shape[1], len(self.second)
        sums = []
        for part, words, radius in ((vector[:half], self.first, self.radius_first), (vector[half:], self.second, self.radius_second)):
            middle, spread = words @ part, radius * np.linalg.norm(part)
            order = np.argsort(-(middle + spread), kind="stable")
            sums.append(((middle + spread)[order].tolist(), (middle - spread)[order].tolist(), order.tolist()))
        (high1, low1, word1), (high2, low2, word2) = sums
        heap = [(-(high1[0] + high2[0]), 0, 0)]
        while heap:
            bound, a, b = heapq.heappop(heap)
            if b + 1 < k:
                heapq.heappush(heap, (-(high1[a] + high2[b + 1]), a, b + 1))
            if b == 0 and a + 1 < len(word1):
                heapq.heappush(heap, (-(high1[a + 1] + high2[0]), a + 1, 0))
            cell = word1[a] * k + word2[b]
            if self.rows[cell]:
                slack = 1e-6 * (1 + abs(bound))  # rounding must not cut a row off
                yield slack - bound, low1[a] + low2[b] - slack, cell

    def visits(self, vector: np.ndarray, floor: int, top: int, again: bool) -> Iterator[int]:
        """Cells of the first round, or those of the second: on until the bound is below `floor`.

        Cells all of whose rows score above `top` are left out.
        """
        met = 0
        for most, least, cell in self.cells(vector):
            if most < floor:
                return
            if least > top:
                continue
            early = met < PROBE
            met += self.rows[cell]
            if early != again:
                yield cell
            elif not early and not again:
                return


class Index(NamedTuple):
    rows: DataFrame
    books: Codebooks
    width: int
    exact_in_double: bool


def usable_rows(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(row, id, label, vector) of the rows that take part."""
    bad = F.exists(F.col("vector"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)


def quantised(rows: DataFrame, width: int, scale: float) -> DataFrame:
    """(row, id, label, q): whole components as 32-bit numbers, and a running number that is written with them."""

    def work(batches):
        for batch in batches:
            x = np.floor(scale * batch.column(2).flatten().to_numpy().reshape(-1, width))
            if x.size and np.abs(x).max() >= 2**31:
                raise ValueError("a component is too great for whole 32-bit numbers")
            q = x.astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in q], pa.binary())], names=["id", "label", "q"])

    out = rows.where(F.size("vector") == width).mapInArrow(tidied(work), "id long, label long, q binary")
    return stage(out.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, width)


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words * words).sum(1)[None] - 2 * (x @ words.T)).argmin(1)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """k codewords; those that lose all rows stay where they are."""
    random = np.random.default_rng(seed)
    words = x[random.choice(len(x), k, replace=len(x) < k)].astype(float)
    for _ in range(rounds):
        own = nearest(x, words)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(words)
        np.add.at(total, own, x)
        words[count > 0] = total[count > 0] / count[count > 0][:, None]
    return words


def fitted(rows: DataFrame, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of both halves from a bounded sample."""
    half = width // 2

    def learn(batches):
        x = [unpacked(b.column(0), width).astype(float) for b in batches if b.num_rows]
        if x:
            x = np.vstack(x)
            x = x[np.lexsort(x.T[::-1])]  # in whatever order rows arrive
            words = [k_means(part, k) for part in (x[:, :half], x[:, half:])]
            yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f8").tobytes()], pa.binary()) for w in words], names=["first", "second"])

    sample = rows.orderBy(F.xxhash64("id", "q"), "id", "q").limit(SAMPLE_ROWS).select("q")
    model = sample.repartition(1).mapInArrow(tidied(learn), "first binary, second binary").first()
    if model is None:
        return np.zeros((k, half)), np.zeros((k, width - half))
    return tuple(np.frombuffer(bytes(m), "<f8").reshape(k, -1) for m in model)


def packed_cells(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(first shard, number of shards) of every cell and the number of shards: small cells share one, great ones have several."""
    shard, chunks = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64)
    now, filled = 0, 0
    for cell in np.flatnonzero(rows):
        n = int(rows[cell])
        if filled and filled + n > SHARD_ROWS:
            now, filled = now + 1, 0
        shard[cell] = now
        if n > SHARD_ROWS:
            chunks[cell] = math.ceil(n / SHARD_ROWS)
            now += int(chunks[cell])
        else:
            filled += n
    return shard, chunks, now + 1


def build_index(rows: DataFrame, key: str, label: str, vector: str, scale: float) -> Index:
    """All usable rows with their cell and shard."""
    spark = rows.sparkSession
    usable = usable_rows(rows, key, label, vector)
    lengths = usable.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("times"))
    most = lengths.orderBy(F.desc("times"), "n").first()
    width = most["n"] if most else 1
    base = quantised(usable, width, scale)
    half = width // 2
    k = min(MOST_WORDS, max(1, math.ceil(math.sqrt((most["times"] if most else 0) / CELL_ROWS))))
    words = spark.sparkContext.broadcast(fitted(base, width, k))

    def assign(batches):
        first, second = words.value
        for batch in batches:
            x = unpacked(batch.column(2), width).astype(float)
            cell, radii = np.zeros(len(x), np.int32), []
            for part, own in ((x[:, :half], first), (x[:, half:], second)):
                at = nearest(part, own)
                cell = cell * k + at
                radii.append(np.linalg.norm(part - own[at], axis=1))
            greatest = np.abs(x).max(1) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(radii[0]), pa.array(radii[1]), pa.array(greatest)],
                names=["id", "label", "q", "row", "cell", "radius1", "radius2", "greatest"])

    placed = base.mapInArrow(tidied(assign), "id long, label long, q binary, row long, cell int, radius1 double, radius2 double, greatest double")
    placed = stage(placed, "cells")
    # One row per cell: MOST_WORDS * MOST_WORDS at most, whatever the input.
    cells = placed.groupBy("cell").agg(F.count("*").alias("rows"), *[F.max(c).alias(c) for c in ("radius1", "radius2", "greatest")]).collect()
    count, radius1, radius2, greatest = np.zeros(k * k, np.int64), np.zeros(k), np.zeros(k), 0.0
    for c in cells:
        count[c["cell"]] = c["rows"]
        i, j = divmod(c["cell"], k)
        radius1[i], radius2[j], greatest = max(radius1[i], c["radius1"]), max(radius2[j], c["radius2"]), max(greatest, c["greatest"])
    if greatest * greatest * width >= 2.0**63:
        raise ValueError("scores do not fit into 64 bits")
    shard, chunks, _ = packed_cells(count)
    plan = spark.createDataFrame([(c, int(shard[c]), int(chunks[c])) for c in range(k * k)], "cell int, shard0 long, chunks long")
    dealt = placed.join(F.broadcast(plan), "cell").withColumn("shard", F.col("shard0") + F.pmod(F.xxhash64("row"), F.col("chunks")))
    books = Codebooks(*words.value, radius1, radius2, count, shard, chunks)
    return Index(dealt.select("shard", "cell", "id", "label", "q", "row"), books, width, greatest * greatest * width < 2.0**53)


REQUEST = "shard long, kind int, row long, id long, label long, q binary, cells array<int>, lows array<long>, highs array<long>, floors array<long>"
WINDOWS = ["lows", "highs", "floors"]


def routed(anchors: DataFrame, index: Index, again: bool) -> DataFrame:
    """Requests: each anchor with the cells it visits of a shard, once for every such shard."""
    books = anchors.sparkSession.sparkContext.broadcast(index.books)
    width = index.width

    def work(batches):
        own = books.value
        for batch in batches:
            out = []
            vectors = unpacked(batch.column("q"), width).astype(float)
            for vector, row in zip(vectors, batch.to_pylist()):
                by_shard: dict[int, list[int]] = {}
                for cell in own.visits(vector, min(row["floors"]), max(row["highs"]), again):
                    for shard in range(own.shard[cell], own.shard[cell] + own.chunks[cell]):
                        by_shard.setdefault(shard, []).append(int(cell))
                out += [row | {"shard": int(shard), "kind": 1, "cells": cells} for shard, cells in by_shard.items()]
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, _REQUEST)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, _REQUEST)

    return anchors.select("row", "id", "label", "q", *WINDOWS).mapInArrow(tidied(work), REQUEST)


_LONGS = pa.list_(pa.int64())
_REQUEST = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("q", pa.binary()),
                      ("cells", pa.list_(pa.int32())), ("lows", _LONGS), ("highs", _LONGS), ("floors", _LONGS)])


class _Shard:
    """Rows of a shard as arrays, in order of id."""

    def __init__(self, parts: list[pa.RecordBatch], width: int, in_double: bool):
        rows = pa.Table.from_batches(parts)
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], rows.column("label").to_numpy()[order]
        self.kind = float if in_double else np.int64
        self.x = unpacked(rows.column("q").combine_chunks(), width)[order].astype(self.kind)
        cells = rows.column("cells").combine_chunks().flatten().to_numpy()[order]
        self.cells, self.cell = np.unique(cells, return_inverse=True)

    def best(self, requests: pa.RecordBatch, width: int, want: int, same: bool) -> Iterator[tuple[int, int, int, int]]:
        """(anchor row, window, id, score) of the best candidates of each request."""
        scores = unpacked(requests.column("q"), width).astype(self.kind) @ self.x.T
        for score, r in zip(scores, requests.to_pylist()):
            asked = np.isin(self.cells, r["cells"])[self.cell]
            lowest, highest = min(max(a, b) for a, b in zip(r["lows"], r["floors"])), max(r["highs"])
            fits = asked & (self.ids != r["id"]) & ((self.labels == r["label"]) == same) & (score >= lowest) & (score <= highest)
            at = np.flatnonzero(fits)
            at = at[np.argsort(-score[at], kind="stable")]
            down = -score[at]
            for window, (low, high, floor) in enumerate(zip(r["lows"], r["highs"], r["floors"])):
                first = np.searchsorted(down, -high, side="left")
                last = np.searchsorted(down, -max(low, floor), side="right")
                for i in range(first, min(last, first + want)):
                    yield r["row"], window, int(self.ids[at[i]]), int(-down[i])


def candidates(requests: DataFrame, index: Index, want: int, same: bool) -> DataFrame:
    """(row, window, id, score): the best of each shard for every request."""
    requests = stage(requests, "requests")
    blocks = requests.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = stage(blocks, "blocks")
    asked = requests.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    none = F.lit(None).cast("array<long>")
    held = index.rows.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.withColumns({"kind": F.lit(0), "cells": F.array("cell")} | {c: none for c in WINDOWS})
    columns = ["shard", "block", "kind", "row", "id", "label", "q", "cells", *WINDOWS]
    both = held.select(*columns).unionByName(asked.select(*columns))
    width, in_double = index.width, index.exact_in_double

    def work(batches):
        place, parts, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "block", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if tuple(keys[:2, a]) != place:
                    place, parts, shard = tuple(keys[:2, a]), [], None
                if keys[2, a] == 0:
                    parts.append(batch.slice(a, b - a))
                    continue
                shard = shard or _Shard(parts, width, in_double)
                for start in range(a, b, TOGETHER):
                    found = list(shard.best(batch.slice(start, min(TOGETHER, b - start)), width, want, same))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _CANDIDATE.types)], schema=_CANDIDATE)

    rows = both.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
    return rows.mapInArrow(tidied(work), "row long, window int, id long, score long")


_CANDIDATE = pa.schema([("row", pa.int64()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def first_of(found: DataFrame, want: int) -> DataFrame:
    """The best of each window with their rank. Spark limits each group before the shuffle."""
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def search(anchors: DataFrame, index: Index, want: int, same: bool) -> DataFrame:
    """(row, window, id, score, rank): per anchor and window of scores the first rows of its label, or of others.

    anchors: row, id, label, q, lows, highs.
    """
    start = anchors.withColumn("floors", F.col("lows"))
    probe = stage(first_of(candidates(routed(start, index, False), index, want, same), want), "probe")
    # A full window's last place is what the rest has to reach.
    full = probe.where(F.col("rank") == want).groupBy(F.col("row").alias("row2")).agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    known = start.join(full, F.col("row") == F.col("row2"), "left")
    floors = F.transform("lows", lambda low, i: F.coalesce(F.try_element_at("reached", i), low))
    rest = candidates(routed(known.withColumn("floors", floors), index, True), index, want, same)
    return stage(first_of(probe.drop("rank").unionByName(rest), want), "found")


def hard_negatives(rows: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` tells anchors by the columns `id` and `label`. For each anchor and each of its first `positives`
    rows of its label, the first `negatives` rows of other labels whose scores are `low` to `high` per cent of the positive's.
    """
    prepare(rows.sparkSession)
    index = build_index(rows, key, label, vector, scale)
    index = index._replace(rows=stage(index.rows, "index"))
    asking = index.rows.where(anchors).select("row", "id", "label", "q")
    everything = asking.withColumns({"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(GREATEST))})
    near = search(everything, index, positives, True).select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place"))
    windows = near.withColumns({"low": F.ceil(F.col("positive_score") * low / F.lit(100).cast("decimal(3,0)")), "high": F.floor(F.col("positive_score") * high / F.lit(100).cast("decimal(3,0)"))})
    windows = windows.withColumns({c: F.col(c).cast("long") for c in ("low", "high")}).where("low <= high")
    lists = windows.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    asked = asking.join(lists, "row").withColumns({"lows": F.col("w.low"), "highs": F.col("w.high"), "places": F.col("w.place")})
    asked = stage(asked.drop("w"), "windows")
    found = search(asked.drop("places"), index, negatives, False)
    placed = found.join(asked.select("row", F.col("id").alias("anchor_id"), F.col("places")), "row")
    placed = placed.withColumn("place", F.element_at("places", F.col("window") + 1))
    return placed.join(near, ["row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
