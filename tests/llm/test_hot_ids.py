"""A third of the rows under one id and a third without id, with different and with equal texts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import fingerprints, lm_scoring, token_files
from stallbook.llm.common import in_order
from tests.llm.conftest import sentence
from tests.llm.test_native import no_python
from tests.llm.test_scoring import brute
from tests.llm.test_tokens import WORD_BPE


def hot_rows(n: int = 900) -> list[tuple]:
    rng = random.Random(21)
    same = " ".join(sentence(rng, 30, 300))
    rows = [(7, " ".join(sentence(rng, 30, 300))) for _ in range(n // 6)] + [(7, same)] * (n // 6)
    rows += [(None, " ".join(sentence(rng, 30, 300))) for _ in range(n // 6)] + [(None, same)] * (n // 6)
    return rows + [(1000 + i, " ".join(sentence(rng, 30, 300))) for i in range(n // 3)]


def test_no_part_is_hot(documents):
    placed = in_order(documents(hot_rows()).select(F.col("doc_id").alias("key"), "text"), "key", "text", 9)
    rows = placed.withColumn("at", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).collect()
    assert max(Counter(r["at"] for r in rows).values()) <= 2 * len(rows) / 9
    rows.sort(key=lambda r: r.place)
    keys = [(r.key is not None, r.key or 0, r.text[:64]) for r in rows]
    assert keys == sorted(keys) and Counter((r.key, r.text) for r in rows) == Counter(hot_rows())


def test_next_documents_across_parts(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "part_count", lambda df: 9)
    rows = hot_rows()
    got = fingerprints.with_next(documents(rows), "doc_id", "text", {"n": F.size})
    assert no_python(got)
    got = got.collect()
    # Every row is the next one of one row, every step goes on in the order, and only one goes back to the start.
    assert Counter(r.text for r in got) == Counter(r.next_text for r in got) == Counter(t for _, t in rows)
    order = lambda t: min((i is not None, i or 0, t[:64]) for i in by_text[t])
    by_text: dict[str, set] = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(i)
    single = [r for r in got if len(by_text[r.text]) == len(by_text[r.next_text]) == 1]
    assert len(single) > 400 and sum(order(r.next_text) < order(r.text) for r in single) <= 1
    assert all(r.next_n == len(r.next_text.split()) for r in got)


def test_token_files_of_a_hot_id(documents, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = hot_rows(300)
    monkeypatch.setattr(token_files, "PART_BYTES", sum(len(t) for _, t in rows) // 9)
    manifest, folder = token_files.write_tokens(documents(rows), WORD_BPE, end_id=1)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2.5 * len(rows) / 9
    got = sorted(map(tuple, token_files.read_tokens(manifest, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])[:-1])).tolist()
    assert Counter((r[0], r[2]) for r in got) == Counter((i, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1) for i, t in rows)


@pytest.mark.parametrize("targets", [{7}, {1001, 1005}])
def test_chunks_of_a_hot_id(spark, documents, monkeypatch, targets):
    rows = [r for r in hot_rows(240) if r[0] is not None or len(r[1]) % 2]
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 2_000)
    goal = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    got = lm_scoring.scores(documents(rows), goal).collect()
    mine = [(r.doc_id, r.n_tokens, *(None if x is None else round(x, 9) for x in (r.target_loss, r.background_loss))) for r in got]
    assert sorted(mine, key=repr) == sorted(brute(rows, targets), key=repr)
