"""Writers and table maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Letters of the export modes.
EXPORT_MODES = {"A": "append", "O": "overwrite", "I": "ignore", "E": "error"}


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a snapshot folder."""
    df.write.mode("overwrite").format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)


def recreate_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Drop and rewrite a catalog table from a query, then read it."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.write.mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return spark.table(table)


def append_to_table(df: DataFrame, table: str) -> None:
    """Append by column name to an existing table."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def create_partitioned_table(
    spark: SparkSession, table: str, columns: str, partitions: list[str], path: str | None = None
) -> None:
    """Create a partitioned fact table if it is absent."""
    location = "" if path is None else f" LOCATION '{path}'"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(partitions)}){location}"
    )


def write_partitioned(
    df: DataFrame, path: str, partitions: list[str], mode: str = "overwrite", counts: dict[str, Column] | None = None
) -> dict[str, int]:
    """Write a folder per partition value; an overwrite replaces only the partitions present.

    Rows are rebalanced by the partition columns: Spark splits a value that holds most rows
    over many tasks and packs small ones together, by the size it measures. ``counts`` names
    conditions; the rows that meet them are counted while they are written, by the tasks
    that write, of which Spark counts each once however often one is repeated.
    """
    rows, seen = df.hint("rebalance", *[F.col(c) for c in partitions]), Observation()
    if counts:
        rows = rows.observe(seen, *[F.count_if(condition).alias(name) for name, condition in counts.items()])
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return {name: int(n) for name, n in seen.get.items()} if counts else {}


def is_late(day: str, slice_day: str, days: int = 30) -> Column:
    """Whether a late row belongs to the days up to and including the slice day."""
    last = F.lit(slice_day).cast("date")
    return F.col(day).between(F.date_sub(last, days), last)


def late_rows(df: DataFrame, day: str, slice_day: str, days: int = 30) -> DataFrame:
    """Late rows of the days up to and including the slice day."""
    return df.where(is_late(day, slice_day, days))


def export_mode(letter: str | None) -> str:
    """Write mode of a mode letter; without one an existing table is an error."""
    if letter is None:
        return EXPORT_MODES["E"]
    try:
        return EXPORT_MODES[letter.upper()]
    except KeyError:
        raise ValueError(f"unknown export mode {letter!r}") from None


def export_jdbc(df: DataFrame, url: str, table: str, letter: str | None, properties: dict[str, str]) -> None:
    """Export to a database table. Errors are raised."""
    df.write.jdbc(url, table, mode=export_mode(letter), properties=properties)
