"""Token ids in flat binary files with 64-bit document offsets, read back memory-mapped.

Format, for each part: `<part>.ids`, the ids of all its documents as little-endian unsigned
integers of 2 bytes (vocabularies up to 65,536) or 4 bytes, one after the other; and
`<part>.index`, little-endian 64-bit: the documents' ids, then each document's first place in
the ids file and the end. A manifest table names the files of every part in document order.
The global place of a part, its base, is the prefix sum of the token counts before it, so
parts are written side by side without knowing of each other.

A task that runs twice writes under another name; only names in the manifest count.

Cases: null and empty texts are the end id alone; documents are ordered by id, a null id first
(kept as the smallest 64-bit number), those with one id by the first characters of their text and
then by its hash, and are cut into parts also among them; repeated rows are documents of their
own; an empty table gives no parts.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.common import (
    SPACED, WordIds, in_order, pieces, prepare,
    split_words, texts_of, tidied, total_bytes, translated,
)
from stallbook.session import scratch_path, stage

# Text bytes that one part holds, on average.
PART_BYTES = 32_000_000
# Distinct words whose ids a Python worker remembers.
REMEMBERED_WORDS = 600_000
NO_ID = -(2**63)
MANIFEST_SCHEMA = "part long, n_docs long, n_tokens long, width int, ids_file string, index_file string"


PLAIN = re.compile(r"[a-z]+").fullmatch
# Added tokens of the vocabulary: a text that holds one keeps its case and its marks in place.
_LETTER = np.isin(np.arange(256), np.arange(97, 123))
_MARK = np.array([33 <= c <= 126 and not chr(c).isalnum() for c in range(256)])


def spread(texts: pa.Array) -> pa.Array:
    """ASCII letters in lower case and a space between a letter and an ASCII punctuation mark after it.

    Neither changes the ids of a tokenizer that lowers case and cuts there anyway; both make
    words recur. Texts with the opening of an added token are left as they are.
    """
    lower = translated(texts, SPACED)
    if not len(texts) or lower.buffers()[2] is None:
        return texts
    held = pc.match_substring(lower, "<|").to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(lower.buffers()[1], dtype=np.int32)[: len(lower) + 1].astype(np.int64)
    raw = np.frombuffer(lower.buffers()[2], dtype=np.uint8)[: offsets[-1]]
    cuts = np.flatnonzero(_LETTER[raw[:-1]] & _MARK[raw[1:]]) + 1
    wider = np.insert(raw, cuts, 32)
    new = pa.StringArray.from_buffers(
        len(lower), pa.py_buffer((offsets + np.searchsorted(cuts, offsets, side="left")).astype(np.int32)), pa.py_buffer(wider.tobytes())
    )
    return pc.if_else(pa.array(held), texts, new) if held.any() else new


class WordEncoder:
    """Ids of texts by way of their distinct words.

    Valid for tokenizers that split at white space and drop it: the ids of a text are then
    those of its white-space-separated words, one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Whether case is dropped and a letter never joins a punctuation mark after it.
        sample = ["Ab", "ab", "ab.", "ab .", "ab,'s", "ab ,'s"]
        ids = [e.ids for e in self.tokenizer.encode_batch(sample, add_special_tokens=False)]
        self.spreads = ids[0] == ids[1] and ids[2] == ids[3] and ids[4] == ids[5]
        self.known = WordIds(REMEMBERED_WORDS)

    def _ids(self, words: list[str]) -> list[list[int]]:
        """Ids of words; a word of small ASCII letters goes to the merge model at once, as nothing else changes or cuts it."""
        plain = self.tokenizer.model.tokenize
        whole = iter(self.tokenizer.encode_batch_fast([w for w in words if not PLAIN(w)], add_special_tokens=False))
        return [[t.id for t in plain(w)] if PLAIN(w) else next(whole).ids for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        codes, offsets, words = split_words(spread(texts) if self.spreads else texts, None)
        names = words.to_pylist()
        if new := self.known.unknown(names):
            lists = self._ids(new)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.known.add(new, sizes, np.fromiter((i for own in lists for i in own), np.uint32, int(sizes.sum())))
        return self.known.sequence(self.known.places(names)[codes], offsets)


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder in each Python worker."""
    return WordEncoder(path)


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as numbers: memory-mapped where its store is a file system, read whole elsewhere."""
    store, root = opened(folder)
    path = f"{root}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=kind)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=kind)


def write_tokens(documents: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, key: str = "doc_id",
                 text: str = "text", vocabulary_size: int = 65_536) -> tuple[DataFrame, str]:
    """Writes the files of all documents in ascending key order; returns the manifest with bases, and the folder."""
    spark = prepare(documents.sparkSession)
    folder = folder or scratch_path(spark, "tokens")
    parts = max(1, math.ceil(total_bytes(documents, text) / PART_BYTES))
    kind = "<u2" if vocabulary_size <= 65_536 else "<u4"
    # Executors make no folder of their own accord in every store.
    store, root = opened(folder)
    store.create_dir(root, recursive=True)

    def write(batches):
        store, root = opened(folder)
        part, keys, sizes, out = TaskContext.get().partitionId(), [], [], None
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        for batch in pieces(batches):
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}.ids")
            ids, n = word_encoder(tokenizer_path).encode(texts_of(batch))
            ends = np.cumsum(n)
            out.write(np.insert(ids, ends, end_id).astype(kind).tobytes())
            keys.append(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False))
            sizes.append(n + 1)
        if out is None:
            return
        out.close()
        sizes, keys = np.concatenate(sizes), np.concatenate(keys)
        with store.open_output_stream(f"{root}/{name}.index") as index:
            index.write(keys.astype("<i8").tobytes() + np.concatenate(([0], np.cumsum(sizes))).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "n_docs": len(keys), "n_tokens": int(sizes.sum()),
                                           "width": int(kind[-1]), "ids_file": f"{name}.ids", "index_file": f"{name}.index"}],
                                         schema=pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                                                           ("width", pa.int32()), ("ids_file", pa.string()), ("index_file", pa.string())]))

    ordered = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    manifest = stage(in_order(ordered, "key", "text", parts).mapInArrow(tidied(write), MANIFEST_SCHEMA), "token-manifest")
    # One short row per part, so one task holds them all.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))), folder


def read_tokens(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_docs"]
                index = mapped(folder, row["index_file"], "<i8")
                ids = mapped(folder, row["ids_file"], f"<u{row['width']}")
                keys, offsets = np.asarray(index[:n]), np.asarray(index[n:])
                for a in range(0, n, 10_000):
                    b = min(n, a + 10_000)
                    crc = [zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in range(a, b)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[a:b], pa.int64(), mask=keys[a:b] == NO_ID), pa.array(row["base"] + offsets[a:b], pa.int64()),
                         pa.array(np.diff(offsets[a : b + 1]), pa.int64()), pa.array(crc, pa.int64())],
                        names=[key, "start", "n_tokens", "ids_crc32"])

    parts = manifest.count()
    spread = manifest.repartition(max(1, parts))
    return spread.mapInArrow(tidied(read), f"{key} long, start long, n_tokens long, ids_crc32 long")
