"""Column renames, schema tolerance, keys and fillers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fillers for missing data.
FILL_TEXT = ""
FILL_NUMBER = -99999
FILL_DATE_MILLIS = -1


@dataclass(frozen=True)
class Renaming:
    source: str
    target: str


def parse_renames(spec: str) -> list[Renaming]:
    """Parse ``"a as b, c"``; ``as`` in any case, a bare name keeps its name."""
    parsed = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        names = re.split(r"\s+as\s+", part, flags=re.IGNORECASE)
        if len(names) > 2 or any(re.search(r"\s", n) for n in names):
            raise ValueError(f"cannot read column specification {part!r}")
        parsed.append(Renaming(names[0], names[-1]))
    return parsed


def rename_by_spec(df: DataFrame, spec: str) -> DataFrame:
    """Rename the listed columns and keep all others."""
    return df.withColumnsRenamed({r.source: r.target for r in parse_renames(spec)})


def select_by_spec(df: DataFrame, spec: str) -> DataFrame:
    """Keep only the listed columns, renamed."""
    return df.select(*[F.col(r.source).alias(r.target) for r in parse_renames(spec)])


def with_wanted_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Exactly the wanted columns in order; absent ones become null text."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[F.col(c).alias(c) if c.lower() in present else F.lit(None).cast("string").alias(c) for c in wanted]
    )


def field_or_empty(df: DataFrame, path: str) -> Column:
    """A nested text field, or the empty text if the field is absent or null."""
    dtype: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(dtype, T.StructType):
            return F.lit("")
        match = [f for f in dtype.fields if f.name.lower() == name.strip("`").lower()]
        if not match:
            return F.lit("")
        dtype = match[0].dataType
    return F.coalesce(F.col(path).cast("string"), F.lit(""))


def with_constants(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def row_key(*columns: str) -> Column:
    """Values joined by an underscore; a null counts as the empty text and keeps its place."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def fill_nulls(df: DataFrame, date_columns: list[str] | None = None) -> DataFrame:
    """Text becomes empty, numbers -99999, listed millisecond dates -1."""
    dates = set(date_columns or [])
    fills: dict[str, object] = {c: FILL_DATE_MILLIS for c in dates}
    for field in df.schema.fields:
        if field.name in dates:
            continue
        if isinstance(field.dataType, T.StringType):
            fills[field.name] = FILL_TEXT
        elif isinstance(field.dataType, T.NumericType):
            fills[field.name] = FILL_NUMBER
    return df.na.fill(fills)
