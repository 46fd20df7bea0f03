"""Functions on arrays, structs and dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_join(c: Column, separator: str = "|") -> Column:
    """Trimmed, non-blank elements joined by a bar; null if nothing is left."""
    kept = F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def struct_join(c: Column, fields: list[str], separator: str = "|") -> Column:
    """Fields of a struct joined by a bar; a null struct is null."""
    parts = [F.coalesce(c.getField(f).cast("string"), F.lit("")) for f in fields]
    return F.when(c.isNotNull(), F.concat_ws(separator, *parts))


def entries_of(df: DataFrame, dictionary: str, key: str, value: str) -> DataFrame:
    """One row per dictionary entry, the key as a column."""
    return df.select(*[c for c in df.columns if c != dictionary], F.explode(dictionary).alias(key, value))


def spread(df: DataFrame, struct: str, fields: dict[str, str]) -> DataFrame:
    """Replace a struct by the listed fields, as {output: field}."""
    keep = [c for c in df.columns if c != struct]
    return df.select(*keep, *[F.col(f"{struct}.{f}").alias(o) for o, f in fields.items()])
