"""Join operators that are more than one DataFrame call.

None of them hints a broadcast for a side that grows with the data: Spark broadcasts below
its size threshold and shuffles beyond it, and splits skewed partitions of a shuffled join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.hot import Ordered, Sort, told_apart

KeyPairs = list[tuple[str, str]]


def lookup(left: DataFrame, right: DataFrame, keys: KeyPairs, how: str = "left") -> DataFrame:
    """Join ``right``, which has one row per key, to rows that may share a hot key.

    A lookup that was grouped or ranked by its key is already partitioned by it, and plain
    equality would join it as it lies; Spark cannot split a hot key then. Null-safe equality
    gives both sides an exchange of their own, which it can. Rows without a key match nothing.
    """
    columns = {b: f"__key{i}" for i, (_, b) in enumerate(keys)}
    present = right.withColumnsRenamed(columns).dropna(subset=list(columns.values()))
    on = [F.col(a).eqNullSafe(F.col(columns[b])) for a, b in keys]
    return left.join(present, on, how).drop(*columns.values())


def star_left(facts: DataFrame, lookups: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left join a chain of lookups: (lookup, fact column, lookup key)."""
    return reduce(lambda f, d: f.join(d[0], F.col(d[1]) == F.col(d[2]), "left"), lookups, facts)


def null_safe(pairs: KeyPairs) -> list[Column]:
    """Equality per pair where null equals null."""
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs]


def null_as_empty(pairs: KeyPairs) -> list[Column]:
    """Case-blind equality per pair where null and the empty text are the same."""
    return [
        F.coalesce(F.lower(F.col(a)), F.lit("")) == F.coalesce(F.lower(F.col(b)), F.lit("")) for a, b in pairs
    ]


def case_blind(pairs: KeyPairs) -> list[Column]:
    return [F.lower(F.col(a)) == F.lower(F.col(b)) for a, b in pairs]


def inner_plus_unmatched(left: DataFrame, right: DataFrame, on: Column | list[Column]) -> DataFrame:
    """Matched rows plus the unmatched left rows: one left join, not a union of two joins."""
    return left.join(right, on, "left")


def left_where_differs(left: DataFrame, right: DataFrame, on, a: str, b: str) -> DataFrame:
    """Left join, then keep rows where ``a`` differs from ``b`` or either is null."""
    return left.join(right, on, "left").where(~F.coalesce(F.col(a) == F.col(b), F.lit(False)))


def match_flag(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, out: str) -> DataFrame:
    """Add 1 where the key exists on the right, else 0, without multiplying rows."""
    known = right.select(right_key.alias("__known")).distinct().withColumn(out, F.lit(1))
    joined = lookup(left.withColumn("__own", left_key), known, [("__own", "__known")]).drop("__own")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def fallback_lookup(
    left: DataFrame,
    exact: DataFrame,
    exact_on: Column | list[Column],
    loose: DataFrame,
    loose_on: Column,
    found: str,
    take: dict[str, tuple[str, str]],
) -> DataFrame:
    """Look up on the exact key first and on a looser key only where nothing was found.

    ``found`` is a column of ``exact`` that is null when there was no match; ``take`` maps an
    output to its (exact, loose) columns.
    """
    first = left.join(exact, exact_on, "left")
    second = first.join(loose, F.col(found).isNull() & loose_on, "left")
    values = {o: F.coalesce(F.col(a), F.col(b)) for o, (a, b) in take.items()}
    drop = [c for pair in take.values() for c in pair if c not in values]
    return second.withColumns(values).drop(*drop)


def guarded_lookup(
    left: DataFrame,
    guard: Column,
    when_true: tuple[DataFrame, Column | list[Column]],
    when_false: tuple[DataFrame, Column | list[Column]],
) -> DataFrame:
    """Two left lookups of which exactly one applies per row. A null guard counts as false."""
    flagged = left.withColumn("__g", F.coalesce(guard, F.lit(False)))
    for (side, on), wanted in ((when_true, F.col("__g")), (when_false, ~F.col("__g"))):
        conditions = on if isinstance(on, list) else [on]
        flagged = flagged.join(side, [wanted, *conditions], "left")
    return flagged.drop("__g")


# Points of one interval that a row stands for at most before it is paired with them.
_SPAN = 1 << 16


def interval_matches(
    points: DataFrame, intervals: DataFrame, keys: KeyPairs, point: str, start: str, end: str
) -> DataFrame:
    """Distinct (keys, point) rows paired with the intervals of the same key that hold the point.

    A null bound is open. Points, starts and ends are swept in one order: a running count numbers the
    points of a key, and an interval holds the points numbered between its start and its end. So
    intervals meet points by equality of (key, number), and every pair that is formed is a result,
    however many points and intervals a key has. Intervals may overlap. Rows without key or point match nothing.
    """
    own = [f"k{i}" for i in range(len(keys))]
    distinct = points.select(*[a for a, _ in keys], point).dropna().distinct()
    present = told_apart(intervals.dropna(subset=[b for _, b in keys]), "__mix", "__interval")
    payload = F.struct(*intervals.columns)
    nothing = F.lit(None)

    def event(kind: int, at: str, with_payload: bool) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), (F.col(at).isNull() & F.lit(at == end)).cast("int").alias("late"), F.col(at).cast("timestamp_ntz").alias("t"),
            F.when(F.lit(with_payload), payload).alias("payload"),
        )

    bounds = present.select(
        *[F.col(b).alias(o) for (_, b), o in zip(keys, own)], F.col("__interval").alias("interval"),
        F.explode(F.array(event(0, start, True), event(2, end, False))).alias("e"),
    ).select(*own, "interval", "e.*")
    marks = distinct.select(
        *[F.col(a).alias(o) for (a, _), o in zip(keys, own)], nothing.cast("long").alias("interval"), F.lit(1).alias("kind"),
        F.lit(0).alias("late"), F.col(point).cast("timestamp_ntz").alias("t"), nothing.cast(bounds.schema["payload"].dataType).alias("payload"),
        F.col(point).alias("point"),
    )
    events = marks.unionByName(bounds, allowMissingColumns=True)
    # An open start has no time and comes first; an open end comes last.
    swept = Ordered.of(events, own, [Sort("late"), Sort("t"), Sort("kind")]).windows(running={"n": (F.col("kind") == 1).cast("long")}).rows()
    flat = {c: f"p{i}" for i, c in enumerate(intervals.columns)}
    starts = swept.where("kind = 0").select("interval", *own, *[F.col(f"payload.{c}").alias(p) for c, p in flat.items()], (F.col("n") + 1).alias("first"))
    ends = swept.where("kind = 2").select("interval", F.col("n").alias("last"))
    spans = starts.join(ends, "interval").where("first <= last")
    blocks = spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / _SPAN), F.floor(F.col("last") / _SPAN))))
    from_, to = F.greatest("first", F.col("block") * _SPAN), F.least("last", (F.col("block") + 1) * _SPAN - 1)
    held = blocks.select(*own, F.explode(F.sequence(from_, to)).alias("n"), *flat.values())
    met = swept.where("kind = 1").select(*own, "n", "point").join(held, [*own, "n"])
    types = {a: distinct.schema[a].dataType for a, _ in keys}
    return met.select(
        *[F.col(o).cast(types[a]).alias(a) for (a, _), o in zip(keys, own)], F.col("point").alias(point), *[F.col(p).alias(c) for c, p in flat.items()]
    )


def interval_join(
    left: DataFrame,
    intervals: DataFrame,
    keys: KeyPairs,
    point: str,
    start: str,
    end: str,
    how: str = "inner",
) -> DataFrame:
    """Join rows to the intervals of the same key in force at the row's point in time."""
    matched = interval_matches(left, intervals, keys, point, start, end)
    own = [a for a, _ in keys] + [point]
    matched = matched.withColumnsRenamed({c: f"__m_{c}" for c in own})
    on = [F.col(c) == F.col(f"__m_{c}") for c in own]
    return left.join(matched, on, how).drop(*[f"__m_{c}" for c in own])


def intersect_intervals(starts: list[str], ends: list[str]) -> tuple[Column, Column]:
    """One interval equal to the overlap of several; a null bound is open."""
    return F.greatest(*[F.col(c) for c in starts]), F.least(*[F.col(c) for c in ends])


def asof_lookup(
    left: DataFrame,
    rates: DataFrame,
    keys: KeyPairs,
    left_day: str,
    rate_day: str,
    value: str,
    prefer: list[str],
    out: str,
) -> DataFrame:
    """The latest value on or before each row's day; the highest ``prefer`` wins within a day.

    Only the distinct (key, day) pairs are ordered, at most one row per key and calendar day
    on either side however many rows a key has; the result joins back on equality.
    """
    own, other = [a for a, _ in keys], [b for _, b in keys]
    daily = rates.groupBy(*[F.col(b).alias(a) for a, b in keys], F.to_date(rate_day).alias("__day")).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*prefer)).alias("__rate")
    )
    wanted = left.select(*own, F.to_date(F.col(left_day)).alias("__day")).distinct()
    wanted = wanted.withColumn("__rate", F.lit(None).cast(daily.schema["__rate"].dataType))
    both = daily.withColumn("__ask", F.lit(0)).unionByName(wanted.withColumn("__ask", F.lit(1)))
    carried = F.last("__rate", ignorenulls=True).over(
        Window.partitionBy(*own).orderBy("__day", "__ask").rowsBetween(Window.unboundedPreceding, 0)
    )
    answers = (
        both.withColumn("__rate", carried)
        .where(F.col("__ask") == 1)
        .select(*[F.col(c).alias(f"__a_{c}") for c in own], "__day", F.col("__rate.v").alias(out))
    )
    on = [F.col(c) == F.col(f"__a_{c}") for c in own] + [F.to_date(F.col(left_day)) == F.col("__day")]
    return left.join(answers, on, "left").drop("__day", *[f"__a_{c}" for c in own])


def week_start(day: Column) -> Column:
    """Monday of the ISO week: an equality key in place of a range join to a week table."""
    return F.to_date(F.date_trunc("week", day))


def join_weeks(rows: DataFrame, day: str, weeks: DataFrame, start: str) -> DataFrame:
    """Join rows to a table of weeks that start on Mondays."""
    return rows.join(weeks, week_start(F.col(day)) == F.col(start), "inner")
