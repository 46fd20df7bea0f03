"""Helpers shared by the text operators: table loading, word splitting in Arrow, hashing.

Python code here runs inside Spark tasks on one Arrow batch at a time.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.operators.hot import told_apart
from stallbook.session import stage, tune

# Rows per Arrow batch: about a thousand whole texts are in a Python worker at a time.
BATCH_ROWS = 1000
# Text bytes of a training sample; a single text of more than a hundredth is not sampled.
SAMPLE_BYTES = 128_000_000
# Characters of a text that order rows with one id, before its hash does.
ORDER_CHARS = 64
# Texts are worked off in pieces of about this many bytes: a piece shares its distinct words' work.
PIECE_BYTES = 8_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# ASCII letters to lower case; words are runs without the six ASCII white-space characters.
SPACED = _LOWER
# The same, and every other ASCII character except digits and letters separates words.
ALPHANUMERIC = bytes(
    c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in (_LOWER[i] for i in range(256))
)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the text operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.sparkContext.applicationId not in _shipped:
        spark.sparkContext.addPyFile(_package())
        _shipped.add(spark.sparkContext.applicationId)
    return spark


_shipped: set[str] = set()


@cache
def _package() -> str:
    """This package as a zip; Spark hands it to the executors, whose Python workers import from it."""
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="stallbook-code-")) / "stallbook.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    return str(path)


def release() -> None:
    """Give memory that Python, numpy and Arrow no longer use back to the system.

    Python workers live on between tasks, so what one stage held would count against the next.
    """
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:
    _libc = None


def tidied(work):
    """A function of batches that releases memory when its task ends."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release()

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of one text column over all rows; sizes partitions, so nothing grows with the input but their number."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def in_order(rows: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows dealt by ranges and sorted: by key, null first, for one key by the first characters of the text, then by its hash.

    A range may end anywhere, also among rows with one key and among equal rows; whole texts never go to the driver.
    """
    told = told_apart(rows, "__mix", "__tell")
    whole = F.coalesce(text, F.lit(""))
    by = [F.col(key).asc(), F.left(whole, F.lit(ORDER_CHARS)), F.xxhash64(whole), F.col("__tell")]
    return told.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("__mix", "__tell")


def training_fold(key: str = "doc_id", folds: int = 5) -> F.Column:
    """True where a row may be learned from: crc32 of the id as text is not divisible by the number of folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds != 0


def bounded_sample(rows: DataFrame, by: str, key: str, most: dict[int, int]) -> DataFrame:
    """At most so many rows of each value of `by`, those with the least hash of the key."""
    parts = [rows.where(F.col(by) == value).orderBy(F.xxhash64(key), key).limit(n) for value, n in most.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(key, by)


def sampled_texts(documents: DataFrame, labels: DataFrame, by: str, key: str, text: str, most: dict[int, int],
                  most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(text, `by`) for one task: distinct texts of at most so many labelled ids of each value of `by`.

    However many rows an id has, there are at most so many rows of each value, those with the least
    hash of the text, and each value's texts have at most an equal share of `most_bytes`.
    """
    sample = bounded_sample(labels, by, key, most)
    # At most as many ids and hashes as `most` allows, so broadcasts whatever the input.
    rows = documents.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key).withColumn("hash", F.xxhash64("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = rows.select("hash", by, size.alias("size")).where(F.col("size") <= most_bytes // 100)
    # An equal text that has both labels counts as the greater one, as an id does.
    sizes = stage(sizes.groupBy("hash").agg(F.max(by).alias(by), F.max("size").alias("size")), "sample-sizes")
    first = bounded_sample(sizes, by, "hash", most).join(sizes.select("hash", "size"), "hash")
    before = Window.partitionBy(by).orderBy(F.xxhash64("hash"), "hash").rowsBetween(Window.unboundedPreceding, 0)
    chosen = first.withColumn("total", F.sum("size").over(before)).where(F.col("total") <= most_bytes // len(most)).select("hash", by)
    return rows.select("hash", "text").join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).select("text", by)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column of a batch, null as the empty text."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.string()), "")


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut so that the texts of one piece hold about `most` bytes; one text is never cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy())
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most - size, side="right"))
            if stop < batch.num_rows:
                stop = max(stop, start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += ends[stop - 1] - before
            if stop < batch.num_rows:
                yield joined(held)
                held, size = [], 0
            start = stop
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def translated(texts: pa.Array, mapping: bytes) -> pa.Array:
    """Every byte of every text through a 256-byte mapping that leaves bytes above 127 alone."""
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = bytes(memoryview(data)[offsets[0] : offsets[-1]]).translate(mapping) if data is not None else b""
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(raw))


def split_words(texts: pa.Array, mapping: bytes | None = SPACED) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, first word of each text plus the end, distinct words) for texts without nulls.

    Splits at ASCII white space after the mapping; empty texts have no words.
    """
    lists = pc.ascii_split_whitespace(translated(texts, mapping) if mapping else texts)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=offsets[1:])
    words = coded.dictionary
    empty = pc.index(words, "").as_py() if len(words) else -1
    if empty >= 0:
        keep = codes != empty
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        codes = codes[keep]
    return codes, offsets, words


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words, the same on every executor."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def shingles(codes: np.ndarray, offsets: np.ndarray, hashed: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of `width` words; a shorter text with words is one shingle of all its words."""
    n = np.diff(offsets)
    h = hashed[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
    rows = np.repeat(np.arange(len(n)), n)
    p = np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros(max(0, len(h) - width + 1), dtype=np.uint64)
    for i in range(width):
        out = out * p + h[i : len(h) - width + 1 + i]
    if len(out):
        inside = rows[: len(out)] == rows[width - 1 :]
        out, at = out[inside], rows[: len(out)][inside]
    else:
        at = np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j, i in enumerate(short):
            value = np.uint64(n[i])
            for x in h[offsets[i] : offsets[i + 1]]:
                value = np.uint64((int(value) * int(p) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            extra[j] = value
        out, at = np.concatenate((out, extra)), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return mixed(out), at


def distinct_per_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, ordered by row and value."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v[keep], r[keep]


class WordIds:
    """Ids of the distinct words a Python worker has met, as flat arrays; forgotten all at once when there are too many."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def unknown(self, words) -> list[str]:
        """Those of distinct words that have to be added."""
        if len(self.place) + len(words) > self.most:
            self.clear()
        place = self.place
        return [w for w in words if w not in place]

    def add(self, words: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        """Words with the number of their ids, and all ids one after the other."""
        n, more = len(self.place), len(words)
        while n + more > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.starts[n : n + more] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + more] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.place.update(zip(words, range(n, n + more)))

    def places(self, words) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def sequence(self, places: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a sequence of words, number of ids of each text), texts given by their first words plus the end."""
        if not len(places):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[places] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.ids[at], np.diff(np.concatenate(([0], ends))[offsets])
