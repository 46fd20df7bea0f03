"""Quality classifier from supervised subword embeddings.

A text is the average of learned vectors: one for each word and for each run of three to five
characters of a word with its borders marked, both hashed into buckets, and one marker for a word
that repeats the one before it. A softmax layer turns the average into class probabilities.
Vectors and layer are trained by numpy stochastic gradient descent, one text at a time.

A trained model is linear in the averaged vectors, so scoring needs, per bucket, the product
of its vector with the difference of the two output vectors: a short table of numbers that is
sent to the tasks, whose size does not depend on the input.

Trained in one task on a bounded sample of labelled rows: at most MAX_ROWS_PER_CLASS of each
class, chosen by a hash of the id, equal texts counted once. The task keeps features, not texts.
Distinct words are worked off WORDS at a time, so memory does not follow the vocabulary of a text.

Cases: a null, empty or wordless text scores the layer's constant, i.e. the class shares of
the sample; repeated rows score alike; null labels are not used; with one class only, or no
labels, the score is 1, 0 or one half for every text. Extra columns pass through;
a column with the new one's name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import (
    SAMPLE_BYTES, mixed, pieces, prepare, release, sampled_texts,
    split_words, texts_of, tidied, training_fold, word_hashes,
)

MAX_ROWS_PER_CLASS = 2500
BUCKETS = 1 << 16
RUNS = (3, 4, 5)
DIMENSIONS = 12
EPOCHS = 6
# Distinct words whose runs are held at a time, and text bytes scored at a time.
WORDS = 20_000
SCORED_BYTES = 4_000_000


def characters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of each character, characters of each word) of words that are not empty."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[: len(words) + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2], dtype=np.uint8)[: offsets[-1]]
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    last = np.append(first[1:], len(raw))
    number = raw[first].astype(np.uint64)
    for k in range(1, 4):
        inside = first + k < last
        number[inside] = (number[inside] << np.uint64(8)) | raw[first[inside] + k]
    return number, np.diff(np.searchsorted(first, offsets))


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, number of features of each word): the word itself and its runs of characters."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number, lengths = characters(pc.binary_join_element_wise("<", words.cast(pa.string()), ">", ""))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(number))  # characters to the word's end
    owner = np.repeat(np.arange(len(words)), lengths)
    buckets, owners = [word_hashes(words)], [np.arange(len(words))]
    for n in RUNS:
        h = np.full(max(0, len(number) - n + 1), n, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + number[k : len(number) - n + 1 + k]
        inside = left[: len(h)] >= n
        buckets.append(mixed(h[inside]))
        owners.append(owner[: len(h)][inside])
    own = np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    bucket = (np.concatenate(buckets)[order] % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    return bucket, np.bincount(own, minlength=len(words))


def word_values(words: pa.Array, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the numbers of its features, number of features) of each word, WORDS words at a time."""
    value, size = np.zeros(len(words)), np.zeros(len(words), np.int32)
    for start in range(0, len(words), WORDS):
        bucket, sizes = word_features(words.slice(start, WORDS))
        ends = np.cumsum(sizes)
        value[start : start + WORDS] = np.add.reduceat(numbers[bucket].astype(np.float64), ends - sizes)
        size[start : start + WORDS] = sizes
    return value, size


def repeats(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: words equal to the word before them in the text."""
    same = np.zeros(len(codes) + 1, dtype=np.int64)
    same[1 : len(codes)] = codes[1:] == codes[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    same[first] = 0
    total = np.concatenate(([0], np.cumsum(same)))
    return total[offsets[1:]] - total[offsets[:-1]]


def rows_of(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares of all its features; bucket 0 is the repeat marker."""
    codes, offsets, words = split_words(texts, None)
    bucket, sizes = word_features(words)
    ends = np.cumsum(sizes)
    again = repeats(codes, offsets)
    out = []
    for i in range(len(texts)):
        own, times = np.unique(codes[offsets[i] : offsets[i + 1]], return_counts=True)
        if not len(own):
            out.append((np.zeros(0, np.uint16), np.zeros(0, np.float32)))
            continue
        n = sizes[own]
        at = np.repeat(ends[own] - np.cumsum(n), n) + np.arange(n.sum())
        weight = np.bincount(bucket[at], np.repeat(times, n), minlength=BUCKETS)
        weight[0] = again[i] * 10.0  # as heavy as a word with its runs
        used = np.flatnonzero(weight)
        out.append((used.astype(np.uint16), (weight[used] / weight.sum()).astype(np.float32)))
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """(number per bucket, constant): the log odds of class 1 are the averaged numbers plus the constant.

    rows: distinct buckets and their shares, as `rows_of` gives them.
    """
    if good.all() or not good.any():
        return np.zeros(BUCKETS, np.float32), 30.0 if len(good) and good.all() else -30.0 if len(good) else 0.0
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = np.zeros((2, DIMENSIONS), np.float32)
    share = good.mean()
    constant = np.log(np.array([1 - share, share], np.float32))
    total = EPOCHS * len(rows)
    for step in range(total):
        if step % len(rows) == 0:
            order = random.permutation(len(rows))
        i = order[step % len(rows)]
        used, weight = rows[i]
        if not len(used):
            continue
        rate = 2.0 * (1 - step / total)
        mean = weight @ vectors[used]
        z = out @ mean + constant
        p = np.exp(z - z.max())
        p /= p.sum()
        p[int(good[i])] -= 1
        back = p @ out
        out -= rate * np.outer(p, mean)
        # The step of a vector is per share of the text: the usual 1/n shrinks with the text's length.
        vectors[used] -= rate * (weight / weight.max())[:, None] * back
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(constant[1] - constant[0])


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          most: int = MAX_ROWS_PER_CLASS, max_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, float]:
    """Fits on the training rows; see the module text for the sample's bound."""
    spark = prepare(documents.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & training_fold(key))
    known = known.groupBy(key).agg(F.max(label).alias("y"))
    rows = sampled_texts(documents, known, "y", key, text, {1: most, 0: most}, max_bytes)

    def learn(batches):
        hashes, found, good = [], [], []
        for batch in batches:
            for start in range(0, batch.num_rows, 50):
                part = batch.slice(start, 50)
                texts = texts_of(part)
                hashes.append(word_hashes(texts))
                found += rows_of(texts)
                good.append(part.column("y").to_numpy(zero_copy_only=False) == 1)
        if not found:
            return
        release()
        # The order in which rows arrive is not the model's business.
        order = np.argsort(np.concatenate(hashes), kind="stable")
        numbers, constant = fit([found[i] for i in order], np.concatenate(good)[order])
        yield pa.RecordBatch.from_arrays([pa.array([numbers.astype("<f4").tobytes()], pa.binary()), pa.array([constant], pa.float64())],
                                         names=["numbers", "constant"])

    model = rows.repartition(1).mapInArrow(tidied(learn), "numbers binary, constant double").first()
    if model is None:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(bytes(model["numbers"]), dtype="<f4"), model["constant"]


def odds(texts: pa.Array, numbers: np.ndarray, constant: float) -> np.ndarray:
    """Log odds of class 1 for each text."""
    codes, offsets, words = split_words(texts, None)
    value, sizes = word_values(words, numbers)
    again = repeats(codes, offsets) * 10.0
    summed = np.concatenate(([0.0], np.cumsum(value[codes]))) if len(codes) else np.zeros(1)
    counted = np.concatenate(([0], np.cumsum(sizes[codes], dtype=np.int64))) if len(codes) else np.zeros(1)
    n = counted[offsets[1:]] - counted[offsets[:-1]] + again
    total = summed[offsets[1:]] - summed[offsets[:-1]] + again * numbers[0]
    return np.where(n > 0, total / np.maximum(n, 1), 0) + constant


def score(documents: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """The documents with one more column: the probability of class 1 for the whole text."""
    spark = prepare(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        numbers, constant = shared.value
        for batch in pieces(batches, text, SCORED_BYTES):
            z = np.clip(odds(texts_of(batch, text), numbers, constant), -30, 30)
            yield batch.append_column(name, pa.array(1 / (1 + np.exp(-z)), pa.float64()))

    rows = documents.drop(name)
    return rows.mapInArrow(tidied(run), rows.withColumn(name, F.lit(0.0)).schema)
