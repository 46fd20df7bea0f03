"""Slices of a dimension in buckets: a run rewrites the buckets that its delta touches and refers to the rest.

Below the root of a store, ``data/Run=<slice>/bucket=<n>`` holds the rows that a run wrote, and
``manifest/Slice=<slice>`` says for every bucket which run's rows are valid in that slice. The manifest is
written last: a run that fails leaves the slices before it as they are, a repeated run replaces its own.
Only the manifest and the numbers of touched buckets pass through the driver, at most one row per bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.joins import lookup
from stallbook.operators.merge import DimensionSpec, newest_delta, publish_dimension, with_open_validity
from stallbook.plans.publish import previous_rows
from stallbook.session import stage

BUCKETS = 256
BUCKET, RUN = "bucket", "Run"


@dataclass(frozen=True)
class BucketStore:
    """Rows dealt to buckets by a hash of the columns ``by``, text in lower case. The number is that of the first slice."""

    root: str
    by: tuple[str, ...]
    buckets: int = BUCKETS

    def dealt(self, rows: DataFrame) -> DataFrame:
        parts = [F.lower(F.col(c)) if rows.schema[c].dataType.simpleString() == "string" else F.col(c) for c in self.by]
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*parts), F.lit(self.buckets)).cast("int"))

    def _runs(self, manifest: DataFrame | None) -> dict[int, int]:
        return {} if manifest is None else {r[BUCKET]: r[RUN] for r in manifest.collect()}

    def runs_before(self, spark: SparkSession, slice_id: int) -> dict[int, int]:
        """The run of each bucket in the newest slice before this one."""
        return self._runs(previous_rows(spark, f"{self.root}/manifest", slice_id))

    def runs_at(self, spark: SparkSession, slice_id: int) -> dict[int, int]:
        return self._runs(spark.read.parquet(f"{self.root}/manifest/Slice={slice_id}"))

    def rows_of(self, spark: SparkSession, runs: dict[int, int], buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of some buckets; the scan is pruned to their folders. None if no run has any."""
        by_run: dict[int, list[int]] = {}
        for bucket, run in runs.items():
            if buckets is None or bucket in buckets:
                by_run.setdefault(run, []).append(bucket)
        if not by_run:
            return None
        own = [(F.col(RUN) == run) & F.col(BUCKET).isin(numbers) for run, numbers in by_run.items()]
        return spark.read.parquet(f"{self.root}/data").where(reduce(Column.__or__, own)).drop(RUN, BUCKET)

    def read(self, spark: SparkSession, slice_id: int) -> DataFrame:
        """The rows of a slice."""
        rows = self.rows_of(spark, self.runs_at(spark, slice_id))
        if rows is None:
            raise ValueError(f"slice {slice_id} of {self.root} has no rows")
        return rows

    def touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in self.dealt(rows).select(BUCKET).distinct().collect()]

    def write(self, rows: DataFrame, slice_id: int, runs: dict[int, int], touched: list[int]) -> None:
        """Write touched buckets and the manifest. ``rows`` are all their rows; a bucket without rows leaves the manifest."""
        spark, path = rows.sparkSession, f"{self.root}/data/{RUN}={slice_id}"
        own = self.dealt(rows).hint("rebalance", F.col(BUCKET))
        own.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)
        # Folder names only: one row per bucket.
        filled = {r[0] for r in spark.read.schema(own.schema).parquet(path).select(BUCKET).distinct().collect()}
        after = {b: run for b, run in runs.items() if b not in touched} | {b: slice_id for b in filled}
        manifest = spark.createDataFrame(sorted(after.items()), f"{BUCKET} int, {RUN} long")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/Slice={slice_id}")


def rewrite(
    store: BucketStore, delta: DataFrame, slice_id: int, change: Callable[[DataFrame | None], DataFrame], more: list[int] = []
) -> list[int]:
    """Write the slice: ``change`` turns the old rows of the touched buckets (None if there are none) into the new ones."""
    spark = delta.sparkSession
    runs = store.runs_before(spark, slice_id)
    touched = sorted({*store.touched(delta), *more})
    store.write(change(store.rows_of(spark, runs, touched)), slice_id, runs, touched)
    return touched


def publish_merged(store: BucketStore, delta: DataFrame, spec: DimensionSpec, slice_id: int, baseline: DataFrame | None = None) -> list[int]:
    """The current rows of a dimension after the delta; returns the rewritten buckets.

    ``delta`` has one row per key (``newest_delta``). The store is dealt by the natural keys, so that the preferred
    source is found within a bucket. A key may have come with other natural keys before: the buckets of such
    rows, found by a scan of the key column alone, are rewritten too.
    """
    spark = delta.sparkSession
    runs = store.runs_before(spark, slice_id)
    old = store.rows_of(spark, runs)
    moved: list[int] = []
    if old is not None:
        keys = delta.select(F.lower(spec.key).alias("__key")).distinct()
        known = store.dealt(old).select(F.lower(spec.key).alias("__own"), BUCKET)
        moved = [r[0] for r in lookup(known, keys, [("__own", "__key")], "left_semi").select(BUCKET).distinct().collect()]

    def change(rows: DataFrame | None) -> DataFrame:
        if old is None:
            after = publish_dimension(delta, spec, None, baseline)
        else:
            after = publish_dimension(delta, spec, delta.limit(0) if rows is None else rows)
        return after.withColumn(spec.key, F.lower(spec.key))

    if old is None and baseline is not None:
        moved = list(range(store.buckets))
    return rewrite(store, delta, slice_id, change, moved)


@dataclass(frozen=True)
class VersionStore:
    """History of a dimension: open versions in buckets, closed ones in one folder per run that is never read to close others."""

    root: str
    key: str
    buckets: int = BUCKETS
    start: str = "start_ts"
    end: str = "end_ts"

    def open_versions(self) -> BucketStore:
        return BucketStore(f"{self.root}/open", (self.key,), self.buckets)

    def publish(self, delta: DataFrame, slice_id: int, as_of: Column) -> list[int]:
        """Close the open version of every key in the delta and add the delta's; returns the rewritten buckets.

        A closed version ends one day before ``as_of``. Rows without key close nothing.
        """
        store, spark = self.open_versions(), delta.sparkSession
        fresh = delta.withColumn(self.key, F.lower(self.key))
        keys = fresh.select(F.col(self.key).alias("__key")).distinct()
        last = as_of - F.expr("INTERVAL 1 DAY")
        runs = store.runs_before(spark, slice_id)
        before = store.rows_of(spark, runs, store.touched(fresh))
        if before is not None:
            ended = lookup(before, keys, [(self.key, "__key")], "left_semi").withColumn(self.end, last)
            ended.write.mode("overwrite").parquet(f"{self.root}/closed/Slice={slice_id}")

        def change(rows: DataFrame | None) -> DataFrame:
            opened = with_open_validity(fresh, as_of, self.start, self.end)
            return opened if rows is None else lookup(rows, keys, [(self.key, "__key")], "left_anti").unionByName(opened)

        return rewrite(store, fresh, slice_id, change)

    def read(self, spark: SparkSession, slice_id: int) -> DataFrame:
        """All versions as of a slice: its open ones and those closed up to it."""
        opened = self.open_versions().read(spark, slice_id)
        closed = previous_closed(spark, f"{self.root}/closed", slice_id)
        return opened if closed is None else opened.unionByName(closed)


def previous_closed(spark: SparkSession, folder: str, slice_id: int) -> DataFrame | None:
    if previous_rows(spark, folder, slice_id + 1) is None:
        return None
    return spark.read.parquet(folder).where(F.col("Slice") <= slice_id).drop("Slice")


def publish_buckets(
    delta: DataFrame, spec: DimensionSpec, root: str, slice_id: int, as_of: Column, baseline: DataFrame | None = None, buckets: int = BUCKETS
) -> tuple[BucketStore, VersionStore]:
    """Write the current rows and the history of a dimension as bucketed slices."""
    delta = stage(newest_delta(delta, spec), "delta")
    merged = BucketStore(f"{root}/merged", spec.natural_keys, buckets)
    versions = VersionStore(f"{root}/historical", spec.key, buckets)
    publish_merged(merged, delta, spec, slice_id, baseline)
    versions.publish(delta, slice_id, as_of)
    return merged, versions
