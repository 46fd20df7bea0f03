"""Slices in buckets: what a run rewrites, what it refers to, and which folders it reads."""

import pytest
from pyspark.sql import functions as F

from stallbook.functions.times import ntz
from stallbook.operators.merge import DimensionSpec
from stallbook.operators.windows import Sort
from stallbook.plans.buckets import BucketStore, VersionStore, publish_buckets, publish_merged, rewrite

SPEC = DimensionSpec("k", (Sort("v", True),), "source", "pubportal", ("n",))


def _rows(spark, data):
    return spark.createDataFrame(data, "k string, n int, v int, source string")


@pytest.fixture
def first(spark):
    return _rows(spark, [(f"K{i}", i, i, "odata") for i in range(60)])


def test_a_delta_of_one_key_rewrites_one_bucket(spark, rows, first, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 8)
    assert publish_merged(store, first, SPEC, 1) == list(range(8))
    before = store.runs_at(spark, 1)
    touched = publish_merged(store, _rows(spark, [("k7", 7, 700, "odata")]), SPEC, 2)
    assert len(touched) == 1
    assert store.runs_at(spark, 2) == before | {touched[0]: 2}
    got = {r.k: r.v for r in store.read(spark, 2).collect()}
    assert got == {f"k{i}": i for i in range(60)} | {"k7": 700}
    assert {r.k: r.v for r in store.read(spark, 1).collect()}["k7"] == 7  # the slice before stays
    files = [{r[0] for r in store.read(spark, n).select(F.input_file_name()).distinct().collect()} for n in (1, 2)]
    assert not any("Run=2" in f for f in files[0]) and any("Run=2" in f for f in files[1]) and any("Run=1" in f for f in files[1])


def test_a_key_that_changes_its_natural_key_is_found(spark, first, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 8)
    publish_merged(store, first, SPEC, 1)
    publish_merged(store, _rows(spark, [("k3", 1000, 3, "odata")]), SPEC, 2)
    got = [(r.k, r.n) for r in store.read(spark, 2).collect()]
    assert len(got) == 60 and ("k3", 1000) in got and ("k3", 3) not in got


def test_the_preferred_source_wins_within_a_bucket(spark, first, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 8)
    publish_merged(store, first, SPEC, 1)
    publish_merged(store, _rows(spark, [("other", 5, 1, "pubportal")]), SPEC, 2)
    assert [r.k for r in store.read(spark, 2).where("n = 5").collect()] == ["other"]


def test_a_repeated_run_replaces_its_own_rows(spark, first, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 8)
    publish_merged(store, first, SPEC, 1)
    for value in (1, 2):
        publish_merged(store, _rows(spark, [("k7", 7, value, "odata")]), SPEC, 2)
    assert [r.v for r in store.read(spark, 2).where("n = 7").collect()] == [2]
    assert store.read(spark, 2).count() == 60


def test_an_empty_delta_refers_to_everything(spark, first, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 8)
    publish_merged(store, first, SPEC, 1)
    assert publish_merged(store, _rows(spark, []), SPEC, 2) == []
    assert store.runs_at(spark, 2) == store.runs_at(spark, 1)


def test_a_bucket_that_loses_all_rows_leaves_the_manifest(spark, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 4)
    rewrite(store, _rows(spark, [("a", 1, 1, "x")]), 1, lambda old: _rows(spark, [("a", 1, 1, "x")]))
    rewrite(store, _rows(spark, [("a", 1, 1, "x")]), 2, lambda old: old.limit(0))
    assert store.runs_at(spark, 2) == {}
    with pytest.raises(ValueError, match="no rows"):
        store.read(spark, 2)


def test_the_baseline_is_in_the_first_slice(spark, tmp_path):
    store = BucketStore(f"{tmp_path}/s", ("n",), 4)
    baseline = spark.createDataFrame([("b", "9", "8", "odata")], "k string, n string, v string, source string")
    publish_merged(store, _rows(spark, [("a", 1, 1, "odata")]), SPEC, 1, baseline)
    assert sorted((r.k, r.n) for r in store.read(spark, 1).collect()) == [("a", 1), ("b", 9)]


def test_closing_reads_open_versions_only(spark, tmp_path):
    store = VersionStore(f"{tmp_path}/h", "k", 4)
    days = ["2024-01-01", "2024-02-01", "2024-03-01"]
    for number, day in enumerate(days):
        delta = _rows(spark, [("A", 1, number, "x"), (None, 2, number, "x")] + ([("b", 3, 0, "x")] if not number else []))
        store.publish(delta, number, ntz(f"{day} 00:00:00"))
    closed = [(r.k, r.v, str(r.start_ts.date()), str(r.end_ts.date())) for r in spark.read.parquet(f"{tmp_path}/h/closed").collect()]
    assert sorted(closed) == [("a", 0, "2024-01-01", "2024-01-31"), ("a", 1, "2024-02-01", "2024-02-29")]
    every = store.read(spark, 2)
    got = sorted(((r.k, r.v, r.end_ts is None) for r in every.collect()), key=repr)
    assert got == sorted([("a", 0, False), ("a", 1, False), ("a", 2, True), ("b", 0, True), (None, 0, True), (None, 1, True), (None, 2, True)], key=repr)
    assert store.read(spark, 0).count() == 3 and store.read(spark, 1).where("end_ts IS NOT NULL").count() == 1
    # What the next run reads to close versions.
    opened = store.open_versions()
    files = opened.rows_of(spark, opened.runs_before(spark, 3)).inputFiles()
    assert files and not any("closed" in f for f in files)


def test_publish_buckets_agrees_with_plain_slices(spark, first, tmp_path):
    merged, versions = publish_buckets(first, SPEC, f"{tmp_path}/d", 1, ntz("2024-01-01 00:00:00"), buckets=4)
    publish_buckets(_rows(spark, [("k1", 1, 100, "pubportal"), ("K1", 1, 50, "odata")]), SPEC, f"{tmp_path}/d", 2, ntz("2024-02-01 00:00:00"), buckets=4)
    assert [(r.v, r.source) for r in merged.read(spark, 2).where(F.lower("k") == "k1").collect()] == [(100, "pubportal")]
    assert versions.read(spark, 2).where("k = 'k1'").count() == 2
