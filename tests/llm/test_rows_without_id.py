"""Decisions fall on the row itself: rows without doc_id, several texts under one id, items without id."""

import hashlib

import corpus_pipeline

from stallbook.llm import decontaminate

ITEM = " ".join(f"b{j}" for j in range(20))
CLEAN = " ".join(f"c{j}" for j in range(20))
OTHER = " ".join(f"o{j}" for j in range(20))


def pairs(frame):
    return sorted(((r.doc_id, r["text"]) for r in frame.collect()), key=repr)


def test_contaminated_rows_go_by_themselves(spark, documents, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents([(None, ITEM), (None, CLEAN), (5, ITEM), (5, CLEAN), (6, None), (None, None), (7, OTHER)])
    kept = corpus_pipeline.not_in_benchmarks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert pairs(kept) == sorted([(None, CLEAN), (5, CLEAN), (6, None), (None, None), (7, OTHER)], key=repr)


def test_copies_go_by_themselves(spark, documents):
    near = " ".join([*CLEAN.split(), *[f"n{j}" for j in range(60)]])
    docs = documents([(None, OTHER), (None, OTHER), (None, CLEAN), (3, CLEAN), (5, CLEAN), (5, ITEM), (8, near), (None, near + " x"),
                      (9, None), (9, None), (9, ""), (None, None), (-4, "a b c"), (-4, "a b c"), (2, "A b  c")])
    kept = corpus_pipeline.without_copies(spark, docs, "")
    assert kept.columns == docs.columns
    expected = [(None, OTHER), (3, CLEAN), (5, ITEM), (8, near), (9, None), (9, ""), (None, None), (-4, "a b c")]
    assert pairs(kept) == sorted(expected, key=repr)


def test_items_without_id_hit_words_but_are_not_listed(spark, documents):
    items = spark.createDataFrame([(None, ITEM), (2, OTHER)], "item_id long, text string")
    got = decontaminate.contamination(documents([(1, ITEM), (2, f"{OTHER} {ITEM}"), (3, CLEAN)]), items).collect()
    sha = {n: hashlib.sha256(n.encode()).hexdigest() for n in ("", "2")}
    assert sorted(map(tuple, got)) == [(1, 20, 20, 0, sha[""], True), (2, 40, 40, 1, sha["2"], True), (3, 20, 0, 0, sha[""], False)]
