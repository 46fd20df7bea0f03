"""The classifiers' training sample is bounded in rows and bytes, however many rows one id has."""

import pytest

from stallbook.llm import common


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, y int")


def test_rows_of_one_id_are_bounded(spark, documents, labels):
    rows = [(1, f"text {k}") for k in range(500)] + [(1, "the same")] * 500 + [(0, None), (2, "two"), (None, "no id"), (3, "three")]
    got = common.sampled_texts(documents(rows), labels, "y", "doc_id", "text", {0: 20, 1: 30}).collect()
    assert sum(r.y for r in got) == 30 and len({r.text for r in got}) == len(got)
    assert {r.text for r in got if not r.y} == {None, "two"}


def test_bytes_are_bounded(spark, documents, labels):
    rows = [(1, f"{k:03d} " + "x" * 96) for k in range(50)] + [(3, "y" * 200), (0, "short")]
    got = common.sampled_texts(documents(rows), labels, "y", "doc_id", "text", {0: 100, 1: 100}, 2000 * 5).collect()
    assert {len(r.text) for r in got} == {100, 5}
    assert sum(len(r.text) for r in got if r.y) <= 5000 and sum(r.y for r in got) == 50
    got = common.sampled_texts(documents(rows), labels, "y", "doc_id", "text", {0: 9, 1: 9}, 10_000).collect()
    assert sum(r.y for r in got) == 9


def test_small_samples_are_whole(spark, documents, labels):
    rows = [(i, f"text of {i}") for i in range(6)] * 2
    got = common.sampled_texts(documents(rows), labels, "y", "doc_id", "text", {0: 100, 1: 100}).collect()
    assert sorted(map(tuple, got)) == sorted((t, i % 2) for i, t in set(rows))
