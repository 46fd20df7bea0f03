"""Readers. Folders are read in one scan; Spark's file packing bounds the size of a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.operators.projections import rename_by_spec
from stallbook.sources.schema import ColumnSpec, apply_types, text_schema


def read_tsv(spark: SparkSession, path: str | list[str], columns: list[ColumnSpec]) -> DataFrame:
    """Headerless tab-separated text with declared columns."""
    raw = spark.read.schema(text_schema(columns)).option("sep", "\t").option("quote", "").csv(path)
    return apply_types(raw, columns)


def read_json(
    spark: SparkSession, path: str | list[str], renames: str | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines, with inferred types unless a schema is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.json(path)
    return df if renames is None else rename_by_spec(df, renames)


def read_json_text(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """JSON lines with the named fields, all as text."""
    return read_json(spark, path, schema=text_schema([ColumnSpec(n) for n in names]))


def read_parquet(spark: SparkSession, path: str | list[str], renames: str | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df if renames is None else rename_by_spec(df, renames)


def read_documents(
    spark: SparkSession, path: str | list[str], array: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """One row per element of the documents' array of structs.

    One document per line lets Spark split a file; ``multi_line`` reads a file in one task.
    """
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return explode_documents(docs, array)


def explode_documents(docs: DataFrame, array: str) -> DataFrame:
    return docs.select(F.explode(array).alias("doc")).select("doc.*")


def look_back(df: DataFrame, day: str, slice_day: str, days: int) -> DataFrame:
    """Rows of the slice day and the ``days - 1`` days before it.

    The raw day column is compared with literals, so partition folders are pruned.
    """
    last = F.lit(slice_day).cast("date")
    return df.where((F.col(day) > F.date_sub(last, days)) & (F.col(day) <= last))


def latest_publication(df: DataFrame, day: str, publication: str) -> DataFrame:
    """Rows of the highest publication id of each day.

    The maximum per day is a small aggregate; a day that holds most rows is not gathered in
    one task.
    """
    newest = df.groupBy(F.col(day).alias("__day")).agg(F.max(publication).alias("__pub"))
    on = (F.col(day) == F.col("__day")) & (F.col(publication) == F.col("__pub"))
    return df.join(newest, on, "left_semi")


def require_days(df: DataFrame, day: str, slice_day: str, days: int) -> None:
    """Fail if a day of the look-back has no row."""
    missing = [str(r[0]) for r in days_without_rows(df, day, slice_day, days).orderBy(day).collect()]
    if missing:
        raise ValueError(f"no data for {', '.join(missing)}")


def days_without_rows(df: DataFrame, day: str, slice_day: str, days: int) -> DataFrame:
    """Days of the look-back without any row."""
    last = F.lit(slice_day).cast("date")
    calendar = df.sparkSession.range(days).select(F.date_sub(last, F.col("id").cast("int")).alias(day))
    return calendar.join(look_back(df, day, slice_day, days).select(day).distinct(), day, "left_anti")


def previous_slice(df: DataFrame, slice_column: str, current: Column) -> DataFrame:
    """Rows of the newest slice strictly before ``current``; none if there is no earlier slice."""
    earlier = df.where(F.col(slice_column) < current)
    newest = earlier.agg(F.max(slice_column).alias("newest"))
    return earlier.where(F.col(slice_column) == newest.scalar())


def external_json_table(
    spark: SparkSession, table: str, path: str, schema: str, columns: list[str] | None = None
) -> DataFrame:
    """Declare a catalog table over a JSON folder and select from it."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({schema}) USING JSON LOCATION '{path}'")
    df = spark.table(table)
    return df if columns is None else df.select(*columns)


def named_sql(spark: SparkSession, text: str, frames: dict[str, DataFrame], **parameters: object) -> DataFrame:
    """Run a SQL text over frames, named in it as {name}, with named parameters bound as literals."""
    return spark.sql(text, args=parameters, **frames)
