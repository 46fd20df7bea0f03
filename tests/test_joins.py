import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stallbook.operators import joins as j

DAY = date(2024, 1, 1)
START = datetime(2024, 1, 1)


def _intervals(spark, data):
    df = spark.createDataFrame(data, "ik int, n int, s string, e string")
    return df.select("ik", "n", F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e"))


def _points(spark, data):
    return spark.createDataFrame(data, "k int, id int, p timestamp_ntz")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_agrees_with_brute_force(spark, rows, how):
    rnd = random.Random(3)
    start = datetime(2023, 11, 15)
    points = [(rnd.choice([1, 2, None]), i, start + timedelta(days=rnd.randint(0, 150), seconds=rnd.choice([0, 86399]))) for i in range(80)]
    points.append((1, 99, None))
    spans = []
    for n in range(120):
        a = start + timedelta(hours=rnd.randint(-2000, 5000))
        b = a + timedelta(hours=rnd.choice([0, 1, 30, 800, 4000, -5]))
        spans.append((rnd.choice([1, 1, 2, 3]), n, rnd.choice([str(a), str(a), None]), rnd.choice([str(b), str(b), None])))
    left, right = _points(spark, points), _intervals(spark, spans)
    got = rows(j.interval_join(left, right, [("k", "ik")], "p", "s", "e", how), "id", "n")
    want = []
    for k, i, p in points:
        hits = [
            (i, n) for ik, n, s, e in spans
            if k is not None and p is not None and ik == k
            and (s is None or str(p) >= s) and (e is None or str(p) <= e)
        ]
        want += hits or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=repr)


def test_intersected_intervals_leave_null_bounds_open(spark):
    df = spark.createDataFrame([(None, 3, None, 9), (None, None, None, None)], "a int, b int, c int, d int")
    start, end = j.intersect_intervals(["a", "b"], ["c", "d"])
    assert [tuple(r) for r in df.select(start, end).collect()] == [(3, 9), (None, None)]


def test_asof_lookup(spark, rows):
    charges = spark.createDataFrame(
        [(1, "EUR", DAY), (2, "EUR", DAY + timedelta(1)), (3, "EUR", DAY + timedelta(9)), (4, "GBP", DAY), (5, None, DAY), (6, "EUR", DAY - timedelta(1))],
        "id int, cur string, day date",
    )
    rates = spark.createDataFrame(
        [("EUR", DAY, 1, 2.0), ("EUR", DAY, 2, 3.0), ("EUR", DAY + timedelta(5), 1, 0.0), ("USD", DAY, 1, 1.0)],
        "rc string, rd date, pulled int, rate double",
    )
    got = j.asof_lookup(charges, rates, [("cur", "rc")], "day", "rd", "rate", ["pulled"], "fx")
    assert rows(got, "id", "fx") == [(1, 3.0), (2, 3.0), (3, 0.0), (4, None), (5, None), (6, None)]


def test_left_where_differs_keeps_nulls(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, None)], "k int, a string")
    right = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c"), (5, None)], "k int, b string")
    assert rows(j.left_where_differs(left, right, "k", "a", "b"), "k") == [(2,), (3,), (4,), (5,)]


def test_fallback_applies_only_without_an_exact_match(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, k string")
    exact = spark.createDataFrame([("a", 10)], "xk string, xv int")
    loose = spark.createDataFrame([("a", 90), ("b", 20)], "lk string, lv int")
    got = j.fallback_lookup(left, exact, F.col("k") == F.col("xk"), loose, F.col("k") == F.col("lk"), "xk", {"v": ("xv", "lv")})
    assert rows(got, "id", "v") == [(1, 10), (2, 20), (3, None)]


def test_guarded_lookup_uses_one_side_per_row(spark, rows):
    left = spark.createDataFrame([(1, True), (1, False), (1, None)], "k int, g boolean")
    a = spark.createDataFrame([(1, "a")], "ak int, av string")
    b = spark.createDataFrame([(1, "b")], "bk int, bv string")
    got = j.guarded_lookup(left, F.col("g"), (a, F.col("k") == F.col("ak")), (b, F.col("k") == F.col("bk")))
    assert rows(got, "g", "av", "bv") == [(False, None, "b"), (None, None, "b"), (True, "a", None)]


def test_match_flag_does_not_multiply_rows(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "r int")
    assert rows(j.match_flag(left, right, F.col("k"), F.col("r"), "hit"), "k", "hit") == [(1, 1), (2, 0), (None, 0)]


def test_null_keys(spark, rows):
    a = spark.createDataFrame([(1, "X"), (2, None), (3, "")], "id int, k string")
    b = spark.createDataFrame([("x", "one"), (None, "none"), ("", "empty")], "r string, n string")
    assert rows(a.join(b, j.null_safe([("k", "r")])), "id", "n") == [(2, "none"), (3, "empty")]
    assert rows(a.join(b, j.null_as_empty([("k", "r")])), "id", "n") == [
        (1, "one"), (2, "empty"), (2, "none"), (3, "empty"), (3, "none"),
    ]


def test_week_key_agrees_with_a_range_join(spark, rows):
    days = spark.createDataFrame([(i, DAY + timedelta(i)) for i in range(40)], "id int, day date")
    weeks = spark.createDataFrame([(DAY + timedelta(7 * i), DAY + timedelta(7 * i + 6)) for i in range(5)], "s date, e date")
    by_range = days.join(weeks, (F.col("day") >= F.col("s")) & (F.col("day") <= F.col("e")))
    assert rows(j.join_weeks(days, "day", weeks, "s"), "id", "s") == rows(by_range, "id", "s")


def test_points_of_a_hot_key_meet_only_intervals_that_hold_them(spark):
    """All points and intervals of one key in one hour: pairs that are formed are results."""
    points = spark.range(2000).select(F.lit(1).alias("k"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("p"))
    at = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 2).cast("decimal(18,6)"))
    intervals = spark.range(900).select(F.lit(1).alias("ik"), F.col("id").alias("n"), at.alias("s"), (at + F.make_dt_interval(secs=F.lit(3))).alias("e"))
    met = j.interval_matches(points, intervals, [("k", "ik")], "p", "s", "e")
    assert met.count() == 900 * 4
    # The pairing join has nothing but equalities.
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "<=" not in [line for line in plan.splitlines() if "Join Inner" in line][0]


@pytest.mark.parametrize("parts", ["2", "30"])
def test_interval_matches_against_all_pairs(spark, parts, monkeypatch):
    monkeypatch.setattr(j, "_SPAN", 4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rnd = random.Random(7)
    day = lambda: rnd.choice([None, *[START + timedelta(hours=rnd.randrange(60)) for _ in range(6)]])
    left = [(rnd.choice([1, 1, 1, 2, None]), day()) for _ in range(150)]
    right = [(rnd.choice([1, 1, 2, 3, None]), day(), day(), rnd.choice(["a", None])) for _ in range(80)] * 2
    try:
        got = j.interval_matches(
            spark.createDataFrame(left, "k int, p timestamp_ntz"), spark.createDataFrame(right, "ik bigint, s timestamp_ntz, e timestamp_ntz, name string"),
            [("k", "ik")], "p", "s", "e",
        )
        want = [(k, p, *r) for k, p in {x for x in left if None not in x} for r in right if r[0] == k and (r[1] is None or r[1] <= p) and (r[2] is None or p <= r[2])]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
