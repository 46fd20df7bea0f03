"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for every training document, the positions of each term that a benchmark
uses (other terms can never match). It is partitioned by document, so a phrase is matched
where its postings are, without moving them. A window of the benchmark is matched by
intersecting the postings of its terms, each shifted by the term's place in the window,
from the rarest term to the commonest; most windows end at the first list.

Benchmarks of any size: they are read in blocks of bounded size, and the index is matched
against one block after the other.

Cases: a null or wordless text or item has no windows and no hits; an item of fewer words
than a window is one window; a repeated document row keeps its own result row; a repeated
item id joins the windows of its rows; the windows of items without id hit words, but count in no
list of items; an empty table of either side gives results without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import ALPHANUMERIC, pieces, prepare, split_words, texts_of, tidied
from stallbook.session import stage

WINDOW_WORDS = 13
# Words of the benchmark that are matched in one pass over the index: about 70 MB of windows in a task.
BLOCK_WORDS = 200_000
# Posting lists of one document are packed into one row per document: terms, list ends, positions.
INDEX_SCHEMA = "key long, row_hash long, n_words long, terms binary, ends binary, positions binary"
MATCH_SCHEMA = "key long, row_hash long, item_id string, first long, last long, n_windows long"


def item_words(texts: list[str | None]) -> list[list[str]]:
    codes, offsets, words = split_words(pa.array([t or "" for t in texts], pa.string()), ALPHANUMERIC)
    names = words.to_pylist()
    return [[names[c] for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]


def windows_of(words: list[str], width: int = WINDOW_WORDS) -> list[tuple[str, ...]]:
    """Distinct runs of `width` words; fewer words, but not none, are one run."""
    if not words:
        return []
    return list(dict.fromkeys(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))))


def blocks(items: DataFrame, id_column: str, text_column: str, most: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, list[str]]]]:
    """Items as (id as text, words), in blocks of about `most` words; one block is on the driver at a time."""
    held: list[tuple[str | None, list[str]]] = []
    size = 0
    rows = items.select(F.col(id_column).cast("string"), F.col(text_column)).toLocalIterator()
    while chunk := list(islice(rows, 500)):
        for (item, _), words in zip(chunk, item_words([t for _, t in chunk])):
            if not words:
                continue
            held.append((item, words))
            size += len(words)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def positional_index(documents: DataFrame, vocabulary: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: postings of the vocabulary's terms, term numbers ascending."""
    prepare(documents.sparkSession)

    def build(batches):
        terms = pa.array(vocabulary, pa.string())
        for batch in pieces(batches):
            texts = texts_of(batch)
            codes, offsets, words = split_words(texts, ALPHANUMERIC)
            number = pc.fill_null(pc.index_in(words, terms), -1).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, int)
            term = number[codes] if len(codes) else np.zeros(0, dtype=np.int64)
            out = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = term[a:b]
                at = np.flatnonzero(own >= 0)
                order = np.argsort(own[at], kind="stable")
                found, starts = np.unique(own[at][order], return_index=True)
                ends = np.append(starts[1:], len(at)) if len(found) else starts
                out.append((found.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), at[order].astype("<u4").tobytes()))
            columns = [pa.array(c, pa.binary()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()), *columns],
                names=["key", "row_hash", "n_words", "terms", "ends", "positions"],
            )

    source = documents.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("row_hash"), F.col(text).alias("text"))
    return source.mapInArrow(tidied(build), INDEX_SCHEMA)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each term of the vocabulary occurs in the whole index; one bounded vector per task is summed."""

    def count(batches):
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            for found, ends in zip(batch.column(0), batch.column(1)):
                t = np.frombuffer(found.as_py(), dtype="<u4")
                total[t] += np.diff(np.frombuffer(ends.as_py(), dtype="<u4").astype(np.int64), prepend=0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["term", "n"])

    counted = index.select("terms", "ends").mapInArrow(tidied(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    result = np.zeros(n_terms, dtype=np.int64)
    for row in counted.toLocalIterator():
        result[row["term"]] = row["n"]
    return result


def plan_windows(items: list[tuple[str, list[str]]], vocabulary: list[str], counts: np.ndarray, width: int) -> tuple[dict, list]:
    """Windows by their rarest term.

    Returns {rarest term: [(steps, length, items)]}, where steps are (term, place in the window)
    from rarest to commonest.
    """
    number = {w: i for i, w in enumerate(vocabulary)}
    owners: dict[tuple[str, ...], set[int]] = {}
    names = sorted({item for item, _ in items}, key=lambda name: (name is None, name or ""))
    index = {n: i for i, n in enumerate(names)}
    for item, words in items:
        for window in windows_of(words, width):
            owners.setdefault(window, set()).add(index[item])
    by_anchor: dict[int, list] = {}
    for window, own in owners.items():
        steps = sorted(((number[w], i) for i, w in enumerate(window)), key=lambda s: (counts[s[0]], s[0], s[1]))
        if counts[steps[0][0]]:
            by_anchor.setdefault(steps[0][0], []).append((np.array(steps, dtype=np.int32), len(window), tuple(sorted(own))))
    return by_anchor, names


def phrase_starts(steps, postings: dict[int, np.ndarray]) -> np.ndarray:
    """Positions where a whole window starts: shifted lists intersected from the rarest term on."""
    starts = None
    for term, place in steps:
        own = postings.get(term)
        if own is None:
            return np.zeros(0, dtype=np.int64)
        shifted = own - place
        if starts is None:
            starts = shifted[shifted >= 0]
        else:
            at = np.searchsorted(shifted, starts)
            at[at == len(shifted)] = 0
            starts = starts[shifted[at] == starts]
        if not len(starts):
            break
    return starts


def near_starts(steps, length: int, slack: int, postings: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """Spans of at most length + slack words, first word on, that hold every term of a window in any order.

    For each occurrence of the rarest term the leftmost such span around it is given.
    """
    terms = list(dict.fromkeys(t for t, _ in steps))
    lists = [postings.get(t) for t in terms]
    if any(p is None for p in lists):
        return []
    span, found = length + slack, []
    for anchor in lists[0]:
        close = [p[(p > anchor - span) & (p < anchor + span)] for p in lists]
        if any(not len(p) for p in close):
            continue
        for left in np.unique(np.concatenate(close)):
            if left > anchor:
                break
            ends = [p[np.searchsorted(p, left)] if p[-1] >= left else left + span for p in close]
            last = max(max(ends), anchor)
            if last - left < span:
                found.append((int(left), int(last)))
                break
    return found


def matches(index: DataFrame, items: list[tuple[str, list[str]]], vocabulary: list[str], counts: np.ndarray,
            width: int = WINDOW_WORDS, slack: int | None = None) -> DataFrame:
    """Runs of hit words per document row and item: first and last word, and the number of windows in the run.

    slack None: exact phrases, adjoining or overlapping ones merged. A number: proximity
    matches instead, all terms of a window within its length plus slack words, not merged.
    """
    plan = plan_windows(items, vocabulary, counts, width)
    shared = index.sparkSession.sparkContext.broadcast(plan)

    def find(batches):
        by_anchor, names = shared.value
        anchors = np.array(sorted(by_anchor), dtype=np.int64)
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                terms = np.frombuffer(batch.column(2)[i].as_py(), dtype="<u4").astype(np.int64)
                present = np.intersect1d(terms, anchors, assume_unique=True)
                if not len(present):
                    continue
                ends = np.frombuffer(batch.column(3)[i].as_py(), dtype="<u4").astype(np.int64)
                positions = np.frombuffer(batch.column(4)[i].as_py(), dtype="<u4").astype(np.int64)
                begins = np.concatenate(([0], ends[:-1]))
                postings = {int(t): positions[a:b] for t, a, b in zip(terms, begins, ends)}
                spans: dict[int, list[tuple[int, int]]] = {}
                for anchor in present:
                    for packed, length, owners in by_anchor[int(anchor)]:
                        steps = packed.tolist()
                        if slack is None:
                            hits = [(int(s), int(s) + length - 1) for s in phrase_starts(steps, postings)]
                        else:
                            hits = near_starts(steps, length, slack, postings)
                        for owner in owners if hits else ():
                            spans.setdefault(owner, []).extend(hits)
                key, row_hash = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for owner, hits in spans.items():
                    for first, last, n in merged(hits) if slack is None else [(a, b, 1) for a, b in sorted(set(hits))]:
                        out.append((key, row_hash, names[owner], first, last, n))
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["key", "row_hash", "item_id", "first", "last", "n_windows"])

    return index.select("key", "row_hash", "terms", "ends", "positions").mapInArrow(tidied(find), MATCH_SCHEMA)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping and adjoining spans as one, with the number of distinct spans in it."""
    out: list[tuple[int, int, int]] = []
    for first, last in sorted(set(spans)):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + 1)
        else:
            out.append((first, last, 1))
    return out


def phrase_matches(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", width: int = WINDOW_WORDS, slack: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(index with the word count of every document row, matches of every item)."""
    index = found = None
    for block in blocks(items, item_id, item_text):
        vocabulary = sorted({w for _, words in block for w in words})
        part = stage(positional_index(documents, vocabulary, key, text), "positional-index")
        index = index or part
        new = matches(part, block, vocabulary, term_counts(part, len(vocabulary)), width, slack)
        found = new if found is None else found.unionByName(new)
    if index is None:
        index = positional_index(documents, [], key, text)
        found = index.sparkSession.createDataFrame([], MATCH_SCHEMA)
    return index, found


def verdicts(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
             item_text: str = "text", width: int = WINDOW_WORDS) -> DataFrame:
    """Per document row: key, row_hash (of the text), n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: at least one word and at least a twentieth of the words are hit.
    """
    index, found = phrase_matches(documents, items, key, text, item_id, item_text, width)
    # A document's runs are few and bounded by its own length.
    spans = found.groupBy("key", "row_hash").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n"),
            F.greatest(acc["end"], s["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    hits = spans.select(
        F.col("key").alias("hit_key"), F.col("row_hash").alias("hit_hash"), covered.alias("hit"),
        F.size("items").cast("long").alias("items"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"),
    )
    own = index.select("key", "row_hash", "n_words")
    joined = own.join(hits, own["key"].eqNullSafe(hits["hit_key"]) & (own["row_hash"] == hits["hit_hash"]), "left")
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return joined.select(
        "key",
        "row_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WINDOW_WORDS) -> DataFrame:
    """Per document row: n_words, n_hit (words inside any occurring window), n_items, items_sha256, contaminated."""
    return verdicts(documents, items, key, text, item_id, item_text, width).drop("row_hash").withColumnRenamed("key", key)
