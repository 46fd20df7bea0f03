"""Audit rows and lineage ids of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, run_id: str, out: str = "data_lineage_id") -> DataFrame:
    return df.withColumn(out, F.lit(run_id))


def slice_audit(
    df: DataFrame, stream: str, slice_id: str, path: str, run_id: str, loaded_at: Column, notes: str = "",
    documents: str | None = None,
) -> DataFrame:
    """One row: how many records a loaded slice has. The count stays on the cluster.

    ``documents`` names an array column whose elements are the records.
    """
    records = F.count(F.lit(1)) if documents is None else F.coalesce(
        F.sum(F.greatest(F.size(documents), F.lit(0))), F.lit(0)
    )
    counted = df.agg(records.cast("bigint").alias("record_count"))
    return counted.select("record_count", *_described(stream, slice_id, path, run_id, loaded_at, notes))


def counted_audit(
    spark: SparkSession, records: int, stream: str, slice_id: str, path: str, run_id: str, loaded_at: Column, notes: str = ""
) -> DataFrame:
    """The audit row of a slice whose records were counted while it was written."""
    return spark.range(1).select(F.lit(records).cast("bigint").alias("record_count"), *_described(stream, slice_id, path, run_id, loaded_at, notes))


def _described(stream: str, slice_id: str, path: str, run_id: str, loaded_at: Column, notes: str) -> list[Column]:
    texts = {"stream": stream, "slice": slice_id, "path": path}
    return [
        *[F.lit(t).alias(c) for c, t in texts.items()], loaded_at.alias("loaded_at"), F.lit(run_id).alias("run_id"), F.lit(notes).alias("notes"),
    ]
