from datetime import date

import pytest
from pyspark.sql import functions as F

from stallbook.functions.times import ntz
from stallbook.operators import merge as m
from stallbook.operators.hot import Sort
from stallbook.operators.sets import checked_union, union_distinct
from stallbook.operators.windows import dedup_flagged_groups, newest, parse_order, prefer_source

SCHEMA = "k string, v int"


def test_upsert(spark, rows):
    old = spark.createDataFrame([("A", 1), ("b", 2), (None, 3)], SCHEMA)
    delta = spark.createDataFrame([("B", 20), ("c", 30), (None, 40)], SCHEMA)
    assert rows(m.upsert(old, delta, "k")) == [("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)]


def test_upsert_with_an_empty_side(spark, rows):
    some, none = spark.createDataFrame([("A", 1)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert rows(m.upsert(some, none, "k")) == [("a", 1)]
    assert rows(m.upsert(none, some, "k")) == [("a", 1)]


HISTORY = "k string, v int, start_ts timestamp_ntz, end_ts timestamp_ntz"


def _history(spark, data):
    plain = spark.createDataFrame(data, "k string, v int, s string, e string")
    return plain.select("k", "v", F.col("s").cast("timestamp_ntz").alias("start_ts"), F.col("e").cast("timestamp_ntz").alias("end_ts"))


def test_history_closes_only_open_versions_of_changed_keys(spark):
    history = _history(spark, [
        ("a", 1, "2020-01-01", "2020-06-01"), ("A", 2, "2020-06-01", "2021-01-01"), ("a", 3, "2021-01-01", None),
        ("b", 4, "2020-01-01", None),
    ])
    delta = spark.createDataFrame([("A", 9), ("c", 8)], SCHEMA)
    got = m.extend_history(history, delta, "k", ntz("2022-01-02 00:00:00"))
    shown = sorted((r.k, r.v, str(r.start_ts)[:10], str(r.end_ts)[:10]) for r in got.collect())
    assert shown == [
        ("a", 1, "2020-01-01", "2020-06-01"), ("a", 2, "2020-06-01", "2021-01-01"), ("a", 3, "2021-01-01", "2022-01-01"),
        ("a", 9, "2022-01-02", "None"), ("b", 4, "2020-01-01", "None"), ("c", 8, "2022-01-02", "None"),
    ]


def test_history_with_an_empty_delta_stays(spark, rows):
    history = _history(spark, [("a", 1, "2020-01-01", None)])
    got = m.extend_history(history, spark.createDataFrame([], SCHEMA), "k", ntz("2022-01-02 00:00:00"))
    assert rows(got) == rows(history)


def test_merge_changes(spark, rows):
    target = spark.createDataFrame([(1, "x", 1), (2, None, 1), (3, "x", None), (4, "x", 4), (None, "n", 1)], "k int, a string, b int")
    source = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (3, None, None), (5, "z", 5), (None, "n", 2)], "k int, a string, b int")
    got = m.merge_changes(target, source, ["k"], ["a", "b"], "action")
    assert rows(got) == [
        (1, "x", 1, "unchanged"), (2, "y", 1, "updated"), (3, None, None, "updated"), (4, "x", 4, "unchanged"),
        (5, "z", 5, "inserted"), (None, "n", 2, "updated"),
    ]


SPEC = m.DimensionSpec("k", (Sort("v", True),), "source", "pubportal", ("k",))


def test_publish_first_load_takes_the_baseline(spark, rows):
    delta = spark.createDataFrame([("A", 1, "pubportal"), ("a", 2, "pubportal")], "k string, v int, source string")
    baseline = spark.createDataFrame([("7", "a", "odata"), ("x", "b", "odata")], "v string, k string, source string")
    assert rows(m.publish_dimension(delta, SPEC, baseline=baseline)) == [("a", 2, "pubportal"), ("b", None, "odata")]


def test_publish_history_starts_open(spark):
    delta = spark.createDataFrame([("A", 1, "pubportal")], "k string, v int, source string")
    first = m.publish_history(delta, SPEC, ntz("2022-01-02 00:00:00"))
    row = first.first()
    assert (row.k, row.end_ts) == ("a", None)
    again = m.publish_history(delta, SPEC, ntz("2022-02-02 00:00:00"), previous=first)
    assert again.where("end_ts is null").count() == 1 and again.count() == 2


def test_checked_union_reorders_and_ignores_case(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "NAME string, Id int")
    assert rows(checked_union(a, b)) == [(1, "x"), (2, "y"), (2, "y")]


@pytest.mark.parametrize("other", ["id int", "id int, nam string", "id int, name string, more int"])
def test_checked_union_refuses_other_columns(spark, other):
    a = spark.createDataFrame([], "id int, name string")
    with pytest.raises(ValueError):
        checked_union(a, spark.createDataFrame([], other))


def test_union_distinct_casts(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, name string")
    b = spark.createDataFrame([("x", "1"), ("y", "bad")], "name string, id string")
    assert rows(union_distinct(a, b)) == [(1, "x"), (None, "y")]


def test_order_specs():
    assert parse_order("a, b asc", True) == [Sort("a", True), Sort("b", False)]
    assert parse_order("a, b DESC", False) == [Sort("a", False), Sort("b", True)]
    with pytest.raises(ValueError):
        parse_order("a sideways", True)
    with pytest.raises(ValueError):
        parse_order(" ", True)


def test_source_priority_keeps_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", "pubportal", 1), ("a", "pubportal", 2), ("a", "odata", 3), ("b", "odata", 4), ("b", "odata", 5), (None, "x", 6)],
        "k string, source string, v int",
    )
    assert rows(prefer_source(df, ["k"], "source", "pubportal"), "v") == [(1,), (2,), (4,), (5,), (6,)]


def test_dedup_of_flagged_groups_only(spark, rows):
    df = spark.createDataFrame([(1, "m", 1), (1, "x", 2), (1, "x", 3), (2, "x", 4), (2, "x", 5)], "g int, n string, t int")
    got = dedup_flagged_groups(df, ["g"], F.col("n") == "m", ["g", "n"], [Sort("t", True)])
    assert rows(got, "t") == [(1,), (3,), (4,), (5,)]


def test_newest_is_one_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 5, "c"), (None, 1, "d")], "k int, v int, n string")
    assert rows(newest(df, ["k"], [Sort("v", True), Sort("n")]), "n") == [("a",), ("c",), ("d",)]


def test_a_repeated_merge_key_fails_the_job(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="merge key is not unique"):
        m.merge_changes(target, source, ["k"], ["v"], "action").collect()
    with pytest.raises(Exception, match="merge key is not unique"):
        m.merge_changes(source, target, ["k"], ["v"], "action").collect()


def test_of_repeated_charges_the_last_counts(spark, rows):
    from stallbook.plans import charges

    columns = "charge_id string, applies_to string, charged_on date, amount double"
    day = date(2024, 1, 2)
    fact = spark.createDataFrame([("c", "x", day, 1.0), ("c", "x", date(2024, 1, 1), 9.0), ("c", "x", day, 2.0)], columns)
    target = spark.createDataFrame([("c", "x", day, 1.0), ("d", "x", day, 4.0)], columns)
    got = charges.merge_charges(target, fact)
    assert rows(got, "charge_id", "amount", "action") == [("c", 2.0, "updated"), ("d", 4.0, "unchanged")]
