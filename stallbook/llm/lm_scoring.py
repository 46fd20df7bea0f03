"""Cross-entropy difference between a target and a background n-gram model.

Two bigram models of the same build, over the one vocabulary of all words that occur: the
background is counted on all documents, the target on those marked as such. A document's score
is its mean loss per word under the target model less that under the background model: the
lower, the more it is like the target.

A model gives a word the share DEEP of its bigram's relative count after the word before it
(the start counts as a word) and the rest from its relative count alone; the target's single
counts are mixed with the background's in the same way. Counts leave out the document that is
scored, or every text would vouch for itself. A word that occurs nowhere else gets half an
occurrence in either model.

Counting by messages: documents are dealt into chunks of about CHUNK_BYTES of text. A chunk
counts its distinct n-grams and sends each count to the bucket that the n-gram's hash names; a
bucket adds up what all chunks sent and answers every chunk with the sums, in the order of its
question; the chunk scores its documents with them. So an n-gram travels once per chunk that
holds it, however often it occurs, a very common one is no more work than a rare one, and no
task, and never the driver, holds more than its share of the model. N-grams are told apart by
56-bit hashes. Documents are dealt by id and text, so the rows of a hot id and the copies of a text
are spread over all chunks; only rows with one id and one text share a chunk. Texts move once, to
their chunk: which ids are targets is found on pairs of chunk and id, without the texts.

Cases: null, empty and wordless texts have no words and null losses; a row without id is no
target and is scored; rows with one id are scored each and are all target if the id is; without
any target the target's losses are those of the single counts; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import SPACED, mixed, prepare, release, split_words, texts_of, total_bytes, word_hashes

CHUNK_BYTES = 6_000_000
DEEP = 0.6
START = np.uint64(0x5EED0F5E47E4CE01)
ALL = np.uint64(0x70741C0DE00001)
SCHEMA = "doc long, n_tokens long, target_loss double, background_loss double"


def single_key(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes + np.uint64(1)) >> np.uint64(8)


class Chunk:
    """The n-grams of some texts: `keys` ordered by bucket and value, and how often each occurs."""

    def __init__(self, texts: pa.Array, target: np.ndarray, buckets: int):
        self.codes, self.offsets, words = split_words(texts, SPACED)
        self.n = np.diff(self.offsets)
        self.rows = np.repeat(np.arange(len(self.n)), self.n)
        self.first = np.zeros(len(self.codes), dtype=bool)
        self.first[self.offsets[:-1][self.n > 0]] = True
        hashes = word_hashes(words)
        own = hashes[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        before = np.roll(own, 1)
        before[self.first] = START
        pairs = mixed(before * np.uint64(0x9E3779B97F4A7C15) + own + np.uint64(2)) >> np.uint64(8)
        pair_keys, self.pair = np.unique(pairs, return_inverse=True)
        weight = target[self.rows].astype(float)
        used = self.n > 0
        self.words, self.pairs = len(words), len(pair_keys)
        keys = np.concatenate((single_key(hashes), pair_keys, single_key(np.array([START])), [ALL]))
        everywhere = np.concatenate((np.bincount(self.codes, minlength=self.words), np.bincount(self.pair, minlength=self.pairs),
                                     [used.sum(), len(self.codes)]))
        in_target = np.concatenate((np.bincount(self.codes, weight, self.words), np.bincount(self.pair, weight, self.pairs),
                                    [(used & target).sum(), weight.sum()]))
        self.bucket = (keys % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((keys, self.bucket))
        self.keys, self.everywhere, self.in_target = keys, everywhere.astype(np.uint32), in_target.astype(np.uint32)

    def messages(self):
        """(bucket, keys, counts everywhere, counts in the target) of each bucket."""
        bucket = self.bucket[self.order]
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        for a, b in zip(starts, np.append(starts[1:], len(bucket))):
            own = self.order[a:b]
            yield int(bucket[a]), packed(self.keys[own], 7), packed(self.everywhere[own], 4), packed(self.in_target[own], 4)

    def losses(self, everywhere: np.ndarray, in_target: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean loss per word of each text under the target and the background; sums in the order of the messages."""
        n, out = len(self.codes), []
        sums = np.zeros((2, len(self.keys)))
        sums[0, self.order], sums[1, self.order] = in_target, everywhere
        once_word = repeated(self.rows, self.codes, self.words)
        once_pair = repeated(self.rows, self.pair, self.pairs)
        once_before = np.where(self.first, 1, np.roll(once_word, 1))
        before = np.where(self.first, self.words + self.pairs, np.roll(self.codes, 1))
        mine = target[self.rows].astype(float)
        base = None
        for count, own in ((sums[1], np.ones(n)), (sums[0], mine)):
            word = count[self.codes] - own * once_word
            pair = count[self.words + self.pair] - own * once_pair
            context = count[before] - own * once_before
            total = count[-1] - own * self.n[self.rows]
            if base is None:
                single = base = np.maximum(word, 0.5) / np.maximum(total, 1)
            else:
                single = np.where(total > 0, DEEP * word / np.maximum(total, 1) + (1 - DEEP) * base, base)
            p = np.where(context > 0, DEEP * pair / np.maximum(context, 1) + (1 - DEEP) * single, single)
            out.append(np.bincount(self.rows, -np.log(p), len(self.n)) / np.maximum(self.n, 1))
        return out[1], out[0]


def repeated(rows: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """For each place, how often its value occurs in its row."""
    _, inverse, times = np.unique(rows * max(1, width) + values, return_inverse=True, return_counts=True)
    return times[inverse] if len(times) else np.zeros(0, np.int64)


def packed(numbers: np.ndarray, width: int) -> bytes:
    """Numbers of `width` bytes, all first bytes before all second ones: shuffles compress the ones that hardly change."""
    return numbers.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - width :] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def among(ids: pa.ChunkedArray, known: pa.Array) -> np.ndarray:
    """Whether each id, null never, is one of the known ones."""
    return pc.and_(pc.is_in(ids, value_set=known), pc.is_valid(ids)).to_numpy().astype(bool)


def scores(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: key, n_tokens, target_loss, background_loss and score, their difference.

    targets: a frame whose column `key` has the ids of the target documents.
    """
    prepare(documents.sparkSession)
    chunks = max(1, math.ceil(total_bytes(documents, text) / CHUNK_BYTES))
    rows = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    # A function of the row alone: the chunk that asks and the one that is answered hold the same rows.
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc", "text"), F.lit(chunks)).cast("int"))
    goal = targets.select(F.col(key).cast("long").alias("target")).where("target IS NOT NULL")
    # One row per chunk and id, so an id has at most as many rows here as there are chunks.
    held = rows.select(F.col("chunk").alias("holder"), F.col("doc").alias("held")).where("held IS NOT NULL").distinct()
    goal = held.join(goal, F.col("held") == F.col("target"), "left_semi")

    def chunk_of(group: pa.Table, targets: pa.Array) -> tuple[Chunk, np.ndarray]:
        texts = texts_of(pa.RecordBatch.from_arrays([group.column("text").combine_chunks()], names=["text"]))
        target = among(group.column("doc"), targets)
        return Chunk(texts, target, chunks), target

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        goals = right.column("held").combine_chunks()
        number = left.column("chunk")[0].as_py()
        # The chunk's target ids come back with the answer of one bucket.
        out, ids = [], goals.to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
        for message in chunk_of(left, goals)[0].messages():
            out.append((number, *message, b"" if out else ids))
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                    names=["chunk", "bucket", "keys", "everywhere", "in_target", "targets"])

    def add(group: pa.Table) -> pa.Table:
        release()
        lists = [unpacked(k, 7) for k in group.column("keys").to_pylist()]
        every = [unpacked(c, 4) for c in group.column("everywhere").to_pylist()]
        inside = [unpacked(c, 4) for c in group.column("in_target").to_pylist()]
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        cuts = np.cumsum([len(own) for own in lists])[:-1]
        sums = [np.split(np.bincount(place, np.concatenate(c))[place].astype(np.uint64), cuts) for c in (every, inside)]
        return pa.Table.from_arrays(
            [group.column("chunk"), group.column("bucket"), group.column("targets"),
             *[pa.array([packed(x, 6) for x in own], pa.binary()) for own in sums]],
            names=["chunk", "bucket", "targets", "everywhere", "in_target"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        right = right.sort_by("bucket")
        sums = [np.concatenate([unpacked(c, 6) for c in right.column(n).to_pylist()]).astype(float) for n in ("everywhere", "in_target")]
        ids = np.frombuffer(b"".join(right.column("targets").to_pylist()), np.int64)
        chunk, target = chunk_of(left, pa.array(ids, pa.int64()))
        goal_loss, base_loss = chunk.losses(*sums, target)
        none = chunk.n == 0
        return pa.Table.from_arrays([left.column("doc"), pa.array(chunk.n, pa.int64()), pa.array(goal_loss, pa.float64(), mask=none),
                                     pa.array(base_loss, pa.float64(), mask=none)], names=["doc", "n_tokens", "target_loss", "background_loss"])

    asked = rows.groupBy("chunk").cogroup(goal.groupBy("holder")).applyInArrow(
        ask, "chunk int, bucket int, keys binary, everywhere binary, in_target binary, targets binary"
    )
    added = asked.groupBy("bucket").applyInArrow(add, "chunk int, bucket int, targets binary, everywhere binary, in_target binary")
    scored = rows.groupBy("chunk").cogroup(added.groupBy("chunk")).applyInArrow(answer, SCHEMA)
    return scored.select(
        F.col("doc").alias(key), "n_tokens", "target_loss", "background_loss",
        (F.col("target_loss") - F.col("background_loss")).alias("score"),
    )
