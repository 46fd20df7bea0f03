"""Unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checked_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name. Both sides must have the same columns, whatever their case and order."""
    if len(first.columns) != len(second.columns):
        raise ValueError(f"column counts differ: {len(first.columns)} and {len(second.columns)}")
    a = {c.lower() for c in first.columns}
    b = {c.lower() for c in second.columns}
    if a != b:
        raise ValueError(f"only on the left: {sorted(a - b)}; only on the right: {sorted(b - a)}")
    own = {c.lower(): c for c in second.columns}
    return first.union(second.select(*[F.col(own[c.lower()]).alias(c) for c in first.columns]))


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows of both, the second cast to the types of the first."""
    return first.union(align_types(second.select(*first.columns), first)).distinct()


def align_types(df: DataFrame, target: DataFrame) -> DataFrame:
    """Cast columns to the types of same-named columns of ``target``; bad text becomes null."""
    types = {f.name.lower(): f.dataType for f in target.schema.fields}
    return df.select(
        *[
            F.col(f.name).try_cast(types[f.name.lower()]).alias(f.name)
            if f.name.lower() in types and types[f.name.lower()] != f.dataType
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
