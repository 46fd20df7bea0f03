"""Ranking operators built on one sort specification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.hot import Sort, ranked, sort_exprs


def parse_order(spec: str, default_descending: bool) -> list[Sort]:
    """Parse ``"a asc, b desc, c"``. A column without direction takes the default."""
    order = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        words = part.split()
        direction = words[1].lower() if len(words) > 1 else ""
        if direction not in ("", "asc", "desc"):
            raise ValueError(f"unknown sort direction in {part!r}")
        order.append(Sort(words[0], default_descending if not direction else direction == "desc"))
    if not order:
        raise ValueError("empty sort specification")
    return order


def parse_columns(spec: str) -> list[str]:
    return [c.strip() for c in spec.split(",") if c.strip()]


def rank_by_spec(
    df: DataFrame,
    partition_by: str,
    order_by: str,
    out: str,
    ties: bool = False,
    default_descending: bool = True,
) -> DataFrame:
    """Add a rank column from two specification strings.

    ``default_descending`` is the direction of a column written without one: callers that
    pass strings use descending, configured callers ascending.
    """
    return ranked(df, parse_columns(partition_by), parse_order(order_by, default_descending), out, ties)


def newest(df: DataFrame, keys: list[str | Column], order: list[Sort | Column]) -> DataFrame:
    """Exactly one row per key: the first in ``order``.

    Filtering a row number lets Spark keep one row per key and map task before the shuffle,
    so a hot key costs no more than any other.
    """
    exprs = [s.column_expr() if isinstance(s, Sort) else s for s in order]
    window = Window.partitionBy(*keys).orderBy(*exprs)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") == 1).drop("__rn")


def keep_best(df: DataFrame, keys: list[str], level: Column) -> DataFrame:
    """All rows whose level is the lowest of their key; ties are kept.

    The minimum is combined before the shuffle and joined back, so many tied rows of one
    key spread over tasks (a skewed join is split, a window group is not).
    """
    leveled = df.withColumn("__level", level)
    best = leveled.groupBy(*keys).agg(F.min("__level").alias("__best"))
    best = best.withColumnsRenamed({k: f"__b_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in keys]
    match.append(F.col("__level").eqNullSafe(F.col("__best")))
    return leveled.join(best, match, "left_semi").drop("__level")


def first_per_second(df: DataFrame, keys: list[str], time: str, tie_breakers: list[str]) -> DataFrame:
    """Drop repeats of an event within one second: the earliest stays."""
    second = F.date_trunc("second", F.col(time))
    return newest(df, [*keys, second], [Sort(time), *[Sort(c) for c in tie_breakers]])


def prefer_source(df: DataFrame, keys: list[str], source: str, preferred: str) -> DataFrame:
    """Keep the rows of the preferred source where a key has any, else all rows of the key."""
    return keep_best(df, keys, F.when(F.col(source) == preferred, 1).otherwise(2))


def dedup_flagged_groups(
    df: DataFrame, group: list[str], flag: Column, keys: list[str], order: list[Sort]
) -> DataFrame:
    """Keep one row per key, but only inside groups that contain a flagged row.

    Rows of other groups pass unchanged. The flagged groups are found with an aggregate that
    is combined before the shuffle.
    """
    flagged = df.where(flag).select(*group).distinct()
    match = [F.col(f"__l.{g}").eqNullSafe(F.col(f"__r.{g}")) for g in group]
    left, right = df.alias("__l"), flagged.alias("__r")
    kept = newest(left.join(right, match, "left_semi"), keys, order)
    return left.join(right, match, "left_anti").unionByName(kept)


def two_row_numbers(
    df: DataFrame, wide_keys: list[str], wide_order: list[Sort], narrow_keys: list[str], narrow_order: list[Sort]
) -> DataFrame:
    """Add ``rn`` over the wide keys, then keep one row per narrow key."""
    return newest(ranked(df, wide_keys, wide_order, "rn"), narrow_keys, narrow_order)


def order_by(*columns: str) -> list[Sort]:
    """Shorthand: ``order_by("ts", "-event_id")``."""
    return [Sort(c.lstrip("-"), c.startswith("-")) for c in columns]


__all__ = [
    "Sort", "dedup_flagged_groups", "first_per_second", "keep_best", "newest", "order_by", "parse_columns",
    "parse_order", "prefer_source", "rank_by_spec", "ranked", "sort_exprs", "two_row_numbers",
]
