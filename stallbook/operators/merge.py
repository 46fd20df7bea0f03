"""Upserts and slowly changing dimensions over immutable snapshots.

Parquet tables have no row-level merge, so each operator returns the new snapshot. Write it
to another path than the one the old snapshot is read from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.operators.joins import lookup
from stallbook.operators.sets import align_types, checked_union
from stallbook.operators.windows import Sort, newest, prefer_source


def _lower_key(key: str) -> Column:
    return F.lower(F.col(key))


def upsert(old: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is absent from the delta, plus the delta. Keys compare case-blind.

    Rows with a null key never match and are kept from both sides.
    """
    lowered_old = old.withColumn(key, _lower_key(key))
    lowered_delta = delta.withColumn(key, _lower_key(key))
    kept = lookup(lowered_old, lowered_delta.select(key).distinct(), [(key, key)], "left_anti")
    return checked_union(kept, lowered_delta)


def with_open_validity(df: DataFrame, as_of: Column, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    return df.withColumns({start: as_of, end: F.lit(None).cast("timestamp_ntz")})


def extend_history(
    history: DataFrame, delta: DataFrame, key: str, as_of: Column, start: str = "start_ts", end: str = "end_ts"
) -> DataFrame:
    """Close the open version of every key in the delta and append the delta as open versions.

    An open version has a null end; it is closed one day before ``as_of``. Closed versions
    and keys outside the delta stay as they are.
    """
    lowered = history.withColumn(key, _lower_key(key))
    fresh = delta.withColumn(key, _lower_key(key))
    keys = fresh.select(key).distinct().withColumn("__hit", F.lit(True))
    closing = F.col("__hit") & F.col(end).isNull()
    closed = (
        lookup(lowered, keys, [(key, key)])
        .withColumn(end, F.when(closing, as_of - F.expr("INTERVAL 1 DAY")).otherwise(F.col(end)))
        .drop("__hit")
    )
    return checked_union(closed, with_open_validity(fresh, as_of, start, end))


def first_load(delta: DataFrame, baseline: DataFrame) -> DataFrame:
    """Start a dimension from an outside baseline, cast to the types of the delta."""
    return checked_union(delta, align_types(baseline, delta))


@dataclass(frozen=True)
class DimensionSpec:
    """How a dimension is published."""

    key: str
    newest_by: tuple[Sort, ...]
    source: str
    preferred_source: str
    natural_keys: tuple[str, ...]


def newest_delta(delta: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per key. Doing it again changes nothing, so a caller may store the result and pass it on."""
    return newest(delta, [F.lower(F.col(spec.key))], list(spec.newest_by))


def publish_dimension(
    delta: DataFrame, spec: DimensionSpec, previous: DataFrame | None = None, baseline: DataFrame | None = None
) -> DataFrame:
    """The current state of a dimension: one delta row per key, merged, best source kept."""
    fresh = newest_delta(delta, spec)
    if previous is not None:
        merged = upsert(previous, fresh, spec.key)
    elif baseline is not None:
        merged = first_load(fresh, baseline)
    else:
        merged = fresh
    return prefer_source(merged, list(spec.natural_keys), spec.source, spec.preferred_source)


def publish_history(
    delta: DataFrame, spec: DimensionSpec, as_of: Column, previous: DataFrame | None = None,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """The version history of a dimension after the delta."""
    fresh = newest_delta(delta, spec)
    if previous is None:
        first = fresh if baseline is None else first_load(fresh, baseline)
        return with_open_validity(first.withColumn(spec.key, _lower_key(spec.key)), as_of)
    return extend_history(previous, fresh, spec.key, as_of)


def merge_changes(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], action: str) -> DataFrame:
    """Update only rows with a changed column, insert new rows, keep the rest.

    Keys match null-safely and must be unique on both sides: a repeated key fails the job, as its
    rows would multiply. ``action`` names a column telling ``updated``, ``inserted`` or ``unchanged``.
    """
    def side(df: DataFrame, mark: str) -> DataFrame:
        named = df.select(*[F.col(c).alias(f"__{mark}_{c}") for c in [*keys, *columns]])
        own = F.count(F.lit(1)).over(Window.partitionBy(*[f"__{mark}_{k}" for k in keys]))
        return named.withColumn(f"__in_{mark}", own)

    t, s = side(target, "t"), side(source, "s")
    on = [F.col(f"__t_{k}").eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"__t_{c}").eqNullSafe(F.col(f"__s_{c}"))
    state = (
        F.when(
            F.greatest("__in_t", "__in_s") > 1,
            F.raise_error(F.concat(F.lit("merge key is not unique: "), F.to_json(F.struct(
                *[F.coalesce(f"__t_{k}", f"__s_{k}").alias(k) for k in keys]
            )))),
        )
        .when(F.col("__in_t").isNull(), "inserted")
        .when(F.col("__in_s").isNull() | same, "unchanged")
        .otherwise("updated")
    )
    from_source = F.col(action) != "unchanged"
    return (
        t.join(s, on, "full_outer")
        .withColumn(action, state)
        .select(
            *[
                F.when(from_source, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}")).alias(c)
                for c in [*keys, *columns]
            ],
            action,
        )
    )
