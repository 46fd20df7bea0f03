"""Sliced windows agree with plain windows, whatever the type, order and nulls of the data."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stallbook.operators.hot import Ordered, Sort, laid_out, neighbours, ranked, sort_exprs, told_apart

BASE = datetime.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def _partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _value(kind, rnd):
    if rnd.random() < 0.1:
        return None
    n = rnd.randint(-40, 40)
    return {
        "timestamp_ntz": BASE + datetime.timedelta(seconds=n * 37),
        "date": (BASE + datetime.timedelta(days=n)).date(),
        "double": rnd.choice([n * 1.5, n * 1e6, 0.0, float("nan"), float("inf"), float("-inf")]),
        "bigint": n * 10**rnd.randint(0, 12),
        "string": rnd.choice(["", "a", "ab", "abc", "abcd", "abce", "é", "b", "zz"]) + str(abs(n) % 3),
    }[kind]


def _frame(spark, kind, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(400):
        key = rnd.choice([None, 1, 1, 1, 1, 2, 3, 4])
        name = rnd.choice(["x", None])
        data.append((i, key, name, _value(kind, rnd), rnd.randint(0, 3)))
    return spark.createDataFrame(data, f"id bigint, key int, name string, v {kind}, w int")


KINDS = ["timestamp_ntz", "date", "double", "bigint", "string"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", ["1", "7", "60"])
def test_ranked(spark, kind, descending, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    df = _frame(spark, kind, 1)
    order = [Sort("v", descending), Sort("w", not descending)]
    unique = [*order, Sort("id")]
    window = Window.partitionBy("key", "name")
    got = ranked(df, ["key", "name"], order, "rk", ties=True)
    got = ranked(got, ["key", "name"], unique, "rn")
    want = df.withColumns(
        {
            "rk": F.rank().over(window.orderBy(*sort_exprs(order))),
            "rn": F.row_number().over(window.orderBy(*sort_exprs(unique))),
        }
    )
    assert {(r.id, r.rk, r.rn) for r in got.collect()} == {(r.id, r.rk, r.rn) for r in want.collect()}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("descending", [False, True])
def test_neighbours(spark, kind, descending):
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    df = _frame(spark, kind, 2)
    order = [Sort("v", descending), Sort("w"), Sort("id")]
    got = neighbours(
        df, ["key", "name"], order, previous={"p": "id", "pw": "w"}, following={"n": "id"},
        before_previous={"p2": "id"},
    )
    window = Window.partitionBy("key", "name").orderBy(*sort_exprs(order))
    want = df.withColumns(
        {
            "p": F.lag("id").over(window), "pw": F.lag("w").over(window), "n": F.lead("id").over(window),
            "p2": F.lag("id", 2).over(window),
        }
    )
    columns = ["id", "p", "pw", "n", "p2"]
    assert {tuple(r) for r in got.select(*columns).collect()} == {tuple(r) for r in want.select(*columns).collect()}


def test_neighbours_keep_null_values_apart_from_no_neighbour(spark, rows):
    data = [(1, 1, None), (1, 2, "b"), (1, 3, None)]
    df = spark.createDataFrame(data, "key int, seq int, v string")
    got = neighbours(df, ["key"], [Sort("seq")], previous={"p": "v"}, following={"n": "v"})
    assert rows(got, "seq", "p", "n") == [(1, None, "b"), (2, None, None), (3, "b", None)]


def test_ranks_of_ties_that_span_several_parts(spark):
    """Eight parts, and most rows equal in all sort columns."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    data = [(i, 1, 5 if i < 700 else 6 + i % 2) for i in range(800)] + [(900, 2, 5), (901, None, 5)]
    df = spark.createDataFrame(data, "id bigint, key int, v int").repartition(5)
    got = {r.id: r.rk for r in ranked(df, ["key"], [Sort("v")], "rk", ties=True).collect()}
    window = Window.partitionBy("key").orderBy("v")
    assert got == {r.id: r.rk for r in df.withColumn("rk", F.rank().over(window)).collect()}


def test_empty_frame(spark):
    df = spark.createDataFrame([], "id bigint, key int")
    assert ranked(df, ["key"], [Sort("id")], "rk", ties=True).collect() == []
    assert neighbours(df, ["key"], [Sort("id")], previous={"p": "id"}).collect() == []


@pytest.mark.parametrize("share", [3, 1])
def test_a_hot_key_with_a_constant_sort_column_is_spread(spark, share):
    """A third of the rows, or all of them, have one key and one value in the first sort column."""
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    rows = spark.range(36_000).select(
        "id", F.when(F.col("id") % share == 0, 0).otherwise(F.col("id")).alias("key"), F.lit(BASE).cast("timestamp_ntz").alias("ts")
    )
    sizes = [r.n for r in laid_out(rows, ["key"], [Sort("ts")]).groupBy("__part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 11 and max(sizes) < 2 * 36_000 / 12
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Windows are written by the tasks that work them out. Parts are dealt to tasks by hash, so a task may get a few of the twelve.
        done = ranked(rows, ["key"], [Sort("ts"), Sort("id")], "rn")
        sizes = [spark.read.parquet(file).count() for file in set(done.inputFiles())]
        assert sum(sizes) == 36_000 and max(sizes) < 36_000 * 0.4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("share", [3, 1])
def test_rows_equal_in_all_columns_are_spread(spark, share):
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    rows = spark.range(24_000).repartition(6).select(
        F.when(F.col("id") % share == 0, 0).otherwise(F.col("id")).alias("key"), F.lit("same").alias("name")
    )
    sizes = [r.n for r in laid_out(rows, ["key"], [Sort("name")]).groupBy("__part").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 11 and max(sizes) < 2 * 24_000 / 12
    got = ranked(rows, ["key"], [Sort("name")], "rn")
    n = 24_000 // share
    assert got.where("key = 0").agg(F.count("*"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first() == (n, n, 1, n)
    assert ranked(rows, ["key"], [Sort("name")], "rk", ties=True).agg(F.max("rk")).first()[0] == 1


def test_numbers_of_equal_rows_do_not_depend_on_the_order_of_arrival(spark):
    data = [(i % 5, "x") for i in range(60)] + [(9, "y")]
    one, two = (spark.createDataFrame(d, "a int, b string").coalesce(1) for d in (data, data[::-1]))
    assert sorted(map(tuple, told_apart(one, "mix", "n").collect())) == sorted(map(tuple, told_apart(two, "mix", "n").collect()))


@pytest.mark.parametrize("parts", ["1", "7", "60"])
def test_one_layout_serves_several_windows(spark, parts):
    """Ranks, neighbours and sums from one pass, and again after rows were left out."""
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    df = _frame(spark, "date", 3)
    order = [Sort("v"), Sort("w", True)]
    unique = [*order, Sort("id")]
    kept = F.coalesce(F.col("id") % 3 != 0, F.lit(True))
    first = Ordered.of(df, ["key"], unique).windows(ranks={"rn": False, "rk": True}, running={"total": F.col("w"), "given": F.when(F.col("w") > 2, 1)}, previous={"p": "id"})
    again = first.replaced(lambda rows: rows.where(kept)).windows(following={"n": "id", "n_rn": "rn"}, before_previous={"p2": "id"}, ranks={"rn2": False})
    walk = Window.partitionBy("key").orderBy(*sort_exprs(unique))
    want = df.withColumns({"rn": F.row_number().over(walk), "rk": F.rank().over(walk), "total": F.sum("w").over(walk), "given": F.sum(F.when(F.col("w") > 2, 1)).over(walk), "p": F.lag("id").over(walk)})
    columns = ["id", "rn", "rk", "total", "given", "p"]
    assert {tuple(r) for r in first.rows().select(*columns).collect()} == {tuple(r) for r in want.select(*columns).collect()}
    want = want.where(kept).withColumns({"n": F.lead("id").over(walk), "n_rn": F.lead("rn").over(walk), "p2": F.lag("id", 2).over(walk), "rn2": F.row_number().over(walk)})
    columns += ["n", "n_rn", "p2", "rn2"]
    assert {tuple(r) for r in again.rows().select(*columns).collect()} == {tuple(r) for r in want.select(*columns).collect()}


def test_a_rank_with_ties_reads_the_ordered_rows_twice(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("key"))
    plan = ranked(df, ["key"], [Sort("id")], "rk", ties=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2


def test_a_key_filter_reaches_the_scan_of_the_ordered_rows(spark):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("key"))
    plan = ranked(df, ["key"], [Sort("id")], "rn").where("key = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(key), EqualTo(key,3)]" in plan
