"""Declared column lists of positional text files and their typed cast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions.times import parse_millis, parse_time

_CASTS = {"int": "int", "long": "bigint", "float": "float", "double": "double", "bool": "boolean"}
_AS_TEXT = ("string", "date", "timestamp")


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column.

    ``date`` columns become milliseconds (-1 if missing) and keep their text as
    ``<name>_orig``; ``timestamp`` columns become times (null if missing). ``pattern`` is
    the text format and ``extract`` a regular expression for the part to parse.
    """

    name: str
    dtype: str = "string"
    pattern: str = "yyyy-MM-dd HH:mm:ss"
    extract: str | None = None

    def __post_init__(self):
        if self.dtype.lower() not in (*_CASTS, *_AS_TEXT):
            raise ValueError(f"unknown type {self.dtype!r} of column {self.name!r}")


def text_schema(columns: list[ColumnSpec]) -> T.StructType:
    """The columns in declared order, all as text."""
    return T.StructType([T.StructField(c.name, T.StringType(), True) for c in columns])


def _typed(spec: ColumnSpec) -> list[Column]:
    c, kind = F.col(spec.name), spec.dtype.lower()
    if kind == "date":
        return [parse_millis(c, spec.extract, spec.pattern).alias(spec.name), c.alias(f"{spec.name}_orig")]
    if kind == "timestamp":
        return [parse_time(c, spec.extract, spec.pattern).alias(spec.name)]
    if kind == "string":
        return [c]
    return [F.trim(c).try_cast(_CASTS[kind]).alias(spec.name)]


def apply_types(df: DataFrame, columns: list[ColumnSpec]) -> DataFrame:
    """Cast a text frame to the declared types; malformed text becomes null."""
    declared = {c.name: c for c in columns}
    exprs = [e for name in df.columns for e in (_typed(declared[name]) if name in declared else [F.col(name)])]
    return df.select(*exprs)
