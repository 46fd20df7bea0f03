"""Exact duplicates by counting quotient filters.

1. Every text has a 64-bit fingerprint and the SHA-256 of its UTF-8 bytes; ids, both hashes and a
   running number are written once, without the text.
2. Every part of that table puts its fingerprints into counting quotient filters: the quotient is a
   fingerprint's place, only the remainder is stored, and a fingerprint met again costs a counter and
   no further slot for itself. So a text that a third of the rows share is one entry of each part.
3. The filters of a range of quotients meet in one task and merge by their sorted remainders without
   loss: the result is what one filter over all rows would hold.
4. Fingerprints with a count above one route their rows to byte verification: the rows are grouped by
   their whole texts, combined before the shuffle. No other text moves.
5. Of each group of equal texts the row with the largest id stays.

Cases: a null text counts as the empty one, and empty texts are equal; rows without id are members of
their group and stay only where no member has an id; of repeated rows (same id and text) exactly one
stays, the first as written; one id with several texts is a member of several groups; an empty table
gives no rows. Columns of other names play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import prepare, tidied
from stallbook.operators.joins import lookup
from stallbook.session import stage

# Fingerprints that the merging task of one range of quotients is meant to meet.
RANGE_ROWS = 1 << 20
# Ranges at least two to the power of this.
RANGE_BITS = 5
# Fingerprints of a part that share one filter at most; bounds the rows that travel.
FILTER_ROWS = 1 << 14


class QuotientFilter:
    """Distinct 64-bit fingerprints with their counts, in quotient filter form.

    Fingerprints are `quotient_bits` of place and a remainder. A run holds the remainders of one
    quotient, ascending; it starts at its quotient's slot or after the run before it. `occupied` marks
    quotients that have a run, `run_end` the last slot of each run. A count above one is written into
    slots after its remainder, marked in `counter`, as digits of the remainder's width, lowest first.
    """

    def __init__(self, quotient_bits: int, occupied: np.ndarray, run_end: np.ndarray, counter: np.ndarray, slots: np.ndarray):
        self.quotient_bits, self.occupied, self.run_end, self.counter, self.slots = quotient_bits, occupied, run_end, counter, slots

    @staticmethod
    def of(fingerprints: np.ndarray, counts: np.ndarray, quotient_bits: int) -> QuotientFilter:
        """From distinct ascending fingerprints and their counts."""
        width = 64 - quotient_bits
        quotient = (fingerprints >> np.uint64(width)).astype(np.int64)
        mask = np.uint64((1 << width) - 1)
        digits, left = [], counts.astype(np.uint64) - np.uint64(1)
        while left.any():
            digits.append(left & mask)
            left = left >> np.uint64(width)
        used = np.ones(len(counts), dtype=np.int64)  # slots of each entry
        for k in range(len(digits)):
            higher = np.any([d > 0 for d in digits[k:]], axis=0)
            used[higher] = k + 2
        # An entry starts at its quotient's slot, or after the entry before it.
        before = np.concatenate(([0], np.cumsum(used)[:-1])) if len(used) else np.zeros(0, np.int64)
        start = np.maximum.accumulate(quotient - before) + before if len(used) else before
        size = max(1 << quotient_bits, int(start[-1] + used[-1]) if len(used) else 0)
        slots, counter = np.zeros(size, np.uint64), np.zeros(size, bool)
        slots[start] = fingerprints & mask
        for k, own in enumerate(digits):
            has = used > k + 1
            slots[start[has] + k + 1] = own[has]
            counter[start[has] + k + 1] = True
        occupied, run_end = np.zeros(size, bool), np.zeros(size, bool)
        occupied[quotient] = True
        last = np.append(quotient[1:] != quotient[:-1], True)[: len(quotient)] if len(quotient) else np.zeros(0, bool)
        run_end[(start + used - 1)[last]] = True
        return QuotientFilter(quotient_bits, occupied, run_end, counter, slots)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct ascending fingerprints, counts): nothing is lost."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        if not len(ends):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        starts = np.maximum(quotients, np.concatenate(([0], ends[:-1] + 1)))
        lengths = ends - starts + 1
        at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        quotient = np.repeat(quotients, lengths).astype(np.uint64)
        head = ~self.counter[at]
        width = 64 - self.quotient_bits
        fingerprints = (quotient[head] << np.uint64(width)) | self.slots[at[head]]
        owner = np.cumsum(head) - 1
        place = np.arange(len(at)) - np.flatnonzero(head)[owner]
        counts = np.ones(len(fingerprints), np.uint64)
        np.add.at(counts, owner[~head], self.slots[at[~head]] << ((place[~head] - 1) * width).astype(np.uint64))
        return fingerprints, counts.astype(np.int64)

    def pack(self) -> bytes:
        """The filter as bytes: slots without content are not written."""
        used = np.zeros(len(self.slots), bool)
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        if len(ends):
            starts = np.maximum(quotients, np.concatenate(([0], ends[:-1] + 1)))
            edge = np.zeros(len(self.slots) + 1, np.int64)
            edge[starts] += 1
            edge[ends + 1] -= 1
            used = np.cumsum(edge[:-1]) > 0
        size = -(-(64 - self.quotient_bits) // 8)
        held = self.slots[used].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
        bits = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter, used)]
        return b"".join([np.array([self.quotient_bits, len(self.slots)], "<u4").tobytes(), *bits, held.tobytes()])

    @staticmethod
    def unpack(data: bytes) -> QuotientFilter:
        quotient_bits, n = (int(x) for x in np.frombuffer(data, "<u4", 2))
        step, at, bits = -(-n // 8), 8, []
        for _ in range(4):
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8, step, at), count=n).astype(bool))
            at += step
        size = -(-(64 - quotient_bits) // 8)
        held = np.frombuffer(data, np.uint8, offset=at).reshape(-1, size)
        slots = np.zeros(n, np.uint64)
        wide = np.zeros((len(held), 8), np.uint8)
        wide[:, :size] = held
        slots[bits[3]] = wide.view("<u8").ravel()
        return QuotientFilter(quotient_bits, *bits[:3], slots)


def counted(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending fingerprints and the sums of their counts."""
    order = np.argsort(fingerprints, kind="stable")
    own = fingerprints[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    each = np.ones(len(own), np.int64) if counts is None else counts[order]
    return own[first], np.add.reduceat(each, first) if len(first) else np.zeros(0, np.int64)


def merged(left: QuotientFilter, right: QuotientFilter) -> QuotientFilter:
    """One filter of both, without loss: remainders of a quotient are sorted in either, counts of equal ones add up."""
    pairs = [f.entries() for f in (left, right)]
    values, counts = counted(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
    return QuotientFilter.of(values, counts, quotient_bits_for(len(values)))


def quotient_bits_for(n: int) -> int:
    """So many quotients that about three in four slots are taken; remainders keep the rest of the 64 bits."""
    return max(1, int(np.ceil(np.log2(max(1, n) / 0.75))))


def filters(keys: DataFrame, fingerprint: str, range_bits: int) -> DataFrame:
    """(range, filter): the quotient filters of each part of the table, cut by the first bits of the fingerprints."""

    def build(batches):
        held: list[np.ndarray] = []
        size = 0

        def out():
            values, counts = counted(np.concatenate(held))
            places = (values >> np.uint64(64 - range_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1], [True])))
            for a, b in zip(cuts[:-1], cuts[1:]):
                packed = QuotientFilter.of(values[a:b] << np.uint64(range_bits), counts[a:b], quotient_bits_for(b - a)).pack()
                yield pa.RecordBatch.from_arrays([pa.array([places[a]], pa.int64()), pa.array([packed], pa.binary())], names=["range", "filter"])

        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size += batch.num_rows
            if size >= FILTER_ROWS << min(range_bits, 6):
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return keys.select(fingerprint).mapInArrow(tidied(build), "range long, filter binary")


def repeated_fingerprints(keys: DataFrame, fingerprint: str) -> DataFrame:
    """(fingerprint, times) of those that occur more than once, from the merged filters."""
    # The number of rows only sets the number of ranges, i.e. of merging tasks.
    range_bits = max(RANGE_BITS, int(np.ceil(np.log2(max(1, keys.count()) / RANGE_ROWS))))

    def merge(batches):
        place, pending = None, []

        def result():
            while len(pending) > 1:
                pending.append(merged(pending.pop(), pending.pop()))
            values, counts = pending[0].entries()
            often = counts > 1
            values = (values[often] >> np.uint64(range_bits)) | (np.uint64(place) << np.uint64(64 - range_bits))
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts[often], pa.int64())], names=[fingerprint, "times"])

        for batch in batches:
            for own, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != place:
                    if pending:
                        yield result()
                    place, pending = own, []
                pending.append(QuotientFilter.unpack(packed.as_py()))
                # Filters of about one size merge, so that each entry is moved a few times only.
                while len(pending) > 1 and len(pending[-2].slots) <= 2 * len(pending[-1].slots):
                    pending.append(merged(pending.pop(), pending.pop()))
        if pending:
            yield result()

    parts = filters(keys, fingerprint, range_bits).repartition("range").sortWithinPartitions("range")
    return parts.mapInArrow(tidied(merge), f"{fingerprint} long, times long")


def exact_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", normal: Callable[[Column], Column] | None = None) -> DataFrame:
    """Per document row: key, keep_id (id of the row that stays), group_size, kept, text_sha256.

    `normal` changes a text before texts are compared (a column function); without it they are compared as they are.
    """
    prepare(documents.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = normal(whole) if normal else whole
    hashes = [F.xxhash64("whole").alias("fingerprint"), F.sha2("whole", 256).alias("sha")]
    texts = documents.select(F.col(key).cast("long").alias("key"), whole.alias("whole"))
    keys = stage(texts.select("key", F.monotonically_increasing_id().alias("row"), *hashes), "text-keys")
    repeated = stage(repeated_fingerprints(keys, "fingerprint").select("fingerprint"), "repeated-fingerprints")

    # Byte verification: whole texts are the grouping key; equal ones are combined before they move.
    suspects = texts.select("whole", hashes[0]).join(repeated, "fingerprint", "left_semi").withColumn("sha", hashes[1])
    verified = suspects.groupBy("fingerprint", "sha", "whole").agg(F.count("*").alias("size"))
    verified = verified.groupBy("fingerprint", "sha").agg(F.sum("size").alias("size"), F.count("*").alias("texts"))
    unlike = F.raise_error(F.concat(F.lit("different texts of one SHA-256: "), "sha"))
    verified = stage(verified.where("size > 1").select("fingerprint", "sha", F.when(F.col("texts") > 1, unlike).otherwise(F.col("size")).alias("size")), "verified")

    # A group may hold a third of the rows: `lookup` lets Spark split its rows, which are combined before they move.
    members = lookup(keys, verified.withColumnsRenamed({"fingerprint": "f", "sha": "s"}), [("fingerprint", "f"), ("sha", "s")], "inner")
    # Largest id first, then the row written first; a row without id comes last.
    stays = F.max(F.struct(F.col("key").isNotNull().alias("named"), "key", (-F.col("row")).alias("back")))
    groups = stage(members.groupBy("fingerprint", "sha").agg(stays.alias("stays"), F.max("size").alias("size")), "groups")
    out = lookup(keys, groups.withColumnsRenamed({"fingerprint": "f", "sha": "s"}), [("fingerprint", "f"), ("sha", "s")])
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("size").isNull(), F.col("key")).otherwise(F.col("stays.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(-F.col("row") == F.col("stays.back"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
