"""Aggregations of event histories. All are combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.windows import parse_columns


def groups_with_zero_sum(df: DataFrame, keys: list[str], amount: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(amount).alias(out)).where(F.col(out) == 0)


def first_event(df: DataFrame, key: str, name: str, event: str, time: str, out: str) -> DataFrame:
    """Earliest time of one kind of event per key."""
    return df.where(F.col(name) == event).groupBy(key).agg(F.min(time).alias(out))


def effective_window(df: DataFrame, key: str, name: str, cancel_event: str, time: str) -> DataFrame:
    """``window_start`` = first event, ``window_end`` = first cancel or null, and the state."""
    return (
        df.groupBy(key)
        .agg(
            F.min(time).alias("window_start"),
            F.min(F.when(F.col(name) == cancel_event, F.col(time))).alias("window_end"),
        )
        .withColumn("window_state", F.when(F.col("window_end").isNull(), "Active").otherwise("Cancelled"))
    )


def group_by_spec(df: DataFrame, group_by: str, aggregates: dict[str, Column]) -> DataFrame:
    """Group by a configured, comma-separated column list."""
    return df.groupBy(*parse_columns(group_by)).agg(*[c.alias(n) for n, c in aggregates.items()])


def sum_of_latest(df: DataFrame, keys: list[str], time: str, extra_keys: list[str], amount: Column, out: str) -> DataFrame:
    """Sum over the rows of each key's latest time, by ``keys + extra_keys``.

    Sums per time come first and the rank is limited before the shuffle, so only the rows of
    each task's latest time travel.
    """
    per_time = df.groupBy(*keys, time, *extra_keys).agg(F.sum(amount).alias(out))
    latest = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(time).desc()))
    return per_time.withColumn("__rank", latest).where(F.col("__rank") == 1).drop("__rank", time)


def usage_rollup(df: DataFrame, keys: list[str], units: Column, cores: Column) -> DataFrame:
    """Total units and units times cores. ``cores`` must be one of, or depend on, the keys."""
    total = F.sum(units)
    return df.groupBy(*keys).agg(total.alias("quantity"), (total * F.max(cores)).alias("core_quantity"))
