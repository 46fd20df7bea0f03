"""Publishing of a dimension, slice by slice.

A dimension has two folders below its root, ``merged`` (current rows) and ``historical``
(versions). Each run reads the newest earlier slice of both and writes a new one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.merge import DimensionSpec, newest_delta, publish_dimension, publish_history
from stallbook.session import stage
from stallbook.sources.writers import export_jdbc, write_snapshot

SLICE = "Slice"


@dataclass(frozen=True)
class Export:
    """Where to export the current rows, and with which mode letter."""

    url: str
    table: str
    letter: str | None
    properties: dict[str, str]


def previous_rows(spark: SparkSession, folder: str, slice_id: int, fmt: str = "parquet") -> DataFrame | None:
    """Rows of the newest slice before ``slice_id``; None if there is no earlier slice."""
    try:
        slices = spark.read.format(fmt).load(folder)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # Only folder names are read to find the slice; the literal then prunes the scan.
    newest = slices.select(SLICE).where(F.col(SLICE) < slice_id).agg(F.max(SLICE)).first()[0]
    return None if newest is None else slices.where(F.col(SLICE) == newest).drop(SLICE)


def publish(
    delta: DataFrame, spec: DimensionSpec, root: str, slice_id: int, as_of: Column,
    baseline: DataFrame | None = None, export: Export | None = None, fmt: str = "parquet",
) -> tuple[str, str]:
    """Write the merged and historical slice of a dimension; returns both folders."""
    spark = delta.sparkSession
    folders = [f"{root}/{kind}" for kind in ("merged", "historical")]
    current, versions = (previous_rows(spark, f, slice_id, fmt) for f in folders)
    merged_path, history_path = (f"{f}/{SLICE}={slice_id}" for f in folders)
    delta = stage(newest_delta(delta, spec), "delta")
    write_snapshot(publish_dimension(delta, spec, current, baseline), merged_path, fmt)
    write_snapshot(publish_history(delta, spec, as_of, versions, baseline), history_path, fmt)
    if export is not None:
        merged = spark.read.format(fmt).load(merged_path)
        export_jdbc(merged, export.url, export.table, export.letter, export.properties)
    return merged_path, history_path
