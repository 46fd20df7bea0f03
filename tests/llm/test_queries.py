"""The registered queries and the pipeline on the smallest tables."""

import os
import random
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stallbook.llm import near_dedup
from stallbook.llm.queries import ORACLES, QUERIES
from tests.harness import compare, duck
from tests.llm.conftest import edited, sentence
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_near_dedup import brute as components

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DIGESTS = {
    "op1_lm_scoring": "doc_id n_tokens target_loss background_loss score",
    "op2_near_dedup": "doc_id n_shingles component_id kept",
    "op3_toxicity": "doc_id held_out score predicted",
    "op5_quality": "doc_id held_out score predicted",
    "op6_pieces": "doc_id piece_ids n_pieces decoded_crc32 same",
    "op7_token_files": "doc_id start n_tokens ids_crc32",
    "op8_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next shingles_estimate",
    "op9_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10_html_text": "page_id url text n_chars",
    "op12_exact_dedup": "doc_id keep_id group_size kept text_sha256",
}

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@needs_tables
@pytest.mark.parametrize("name", list(DIGESTS))
def test_one_row_per_row_of_the_table(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    table = "pages" if name == "op10_html_text" else "documents"
    assert frame.columns == DIGESTS[name].split()
    assert frame.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@needs_tables
@pytest.mark.parametrize("name", list(ORACLES))
def test_agrees_with_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLES[name]) == []


def written(spark, folder, rows, labels, items):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_against_brute_force(spark, tmp_path):
    rng, rows, labels = random.Random(9), [], []
    items = [(k, " ".join(f"b{k}x{j}" for j in range(30))) for k in range(3)]
    for i in range(500):
        words = sentence(rng, rng.randrange(20, 90), 3000)
        toxic, bad = rng.random() < 0.15, rng.random() < 0.15
        if toxic:
            words[3:3] = ["zorkaful", "idiot"]
        if bad:
            words = [w.upper() + "!!!" for w in words]
        if i % 40 == 1:
            words[5:5] = items[i % 3][1].split()
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    clean = [r for r, lab in zip(rows, labels) if lab[1] and not lab[2]]
    for k in range(60):
        rows.append((1000 + k, " ".join(edited(rng, rng.choice(clean)[1].split(), rng.randrange(0, 2)))))
    rows += [(2000, None), (2001, ""), clean[0], (None, "a text without an id that stays")]
    folder = written(spark, tmp_path / "in", rows, labels, items)

    docs = corpus_pipeline.table(spark, folder, "documents")
    kept = []
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, folder), "test")
        kept.append([(r.doc_id, r["text"] if "text" in docs.columns else r.same) for r in docs.collect()])
    by_label = {i: (q, t) for i, q, t in labels}
    assert {i for i, _ in rows} - {i for i, _ in kept[0]} == {i for i, (q, t) in by_label.items() if t}
    assert {i for i, _ in kept[0]} - {i for i, _ in kept[1]} <= {i for i, (q, t) in by_label.items() if not q} | {2000, 2001}
    expected, _ = components([r for r in kept[1] if r[0] is not None], corpus_pipeline.ALIKE_PERCENT)
    assert sorted((i for i, _ in kept[2]), key=repr) == sorted([*{i for i, c in expected.items() if i == c}, None], key=repr)
    assert sorted(kept[3], key=repr) == sorted((r for r in kept[2] if not contamination(r[1], items)[4]), key=repr)
    assert sorted(kept[4], key=repr) == sorted(((i, True) for i, _ in kept[3]), key=repr)
    assert sorted(r.doc_id or -1 for r in corpus_pipeline.run(spark, folder).collect()) == sorted(i or -1 for i, _ in kept[4])


def test_pipeline_over_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path / "in", [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_code_names_no_reader_of_local_files():
    """Operators read inputs through Spark alone."""
    top = os.path.dirname(near_dedup.__file__)
    for name in os.listdir(top):
        if name.endswith(".py"):
            with open(os.path.join(top, name)) as file:
                assert not re.search(r"localCheckpoint|crossJoin|\.toPandas\(|\bglob\b", file.read()), name
