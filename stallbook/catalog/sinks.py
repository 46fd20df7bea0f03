"""Writers. Results are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import times
from stallbook.operators.audit import slice_audit, with_lineage
from stallbook.session import scratch_path, scratch_table
from stallbook.sources import readers, writers

RUN_ID = "run-2024-01-20"
EVENTS_SQL = "SELECT event_id, user_id, event_type, value FROM events"
EVENTS = ["event_id", "user_id", "event_type", "value"]
EVENTS_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


@query("k_overwrite_roundtrip", EVENTS_SQL)
def k_overwrite_roundtrip(t: Tables):
    path = scratch_path(t.spark, "overwrite")
    rows = t.events.select(*EVENTS)
    writers.write_snapshot(rows.where(F.col("event_type") == "error"), path, "json")
    writers.write_snapshot(rows, path, "json")
    return readers.read_json(t.spark, path, schema=EVENTS_SCHEMA)


@query("k_append_roundtrip", f"{EVENTS_SQL} UNION ALL {EVENTS_SQL} WHERE event_type = 'error'")
def k_append_roundtrip(t: Tables):
    table, path = scratch_table("events"), scratch_path(t.spark, "append")
    rows = t.events.select(*EVENTS)
    writers.recreate_table(rows, table, path)
    writers.append_to_table(rows.where(F.col("event_type") == "error").select(*reversed(EVENTS)), table)
    return t.spark.table(table)


@query("k_parquet_handoff", "SELECT 'S' || o_custkey AS subscription_id FROM orders")
def k_parquet_handoff(t: Tables):
    path = scratch_path(t.spark, "handoff")
    ids = t.orders.select(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("subscription_id"))
    writers.write_snapshot(ids, path)
    return readers.read_parquet(t.spark, path)


@query("k_recreate_table", "SELECT o_orderstatus, count(*) AS order_count FROM orders GROUP BY 1")
def k_recreate_table(t: Tables):
    table, path = scratch_table("orders"), scratch_path(t.spark, "table")
    writers.recreate_table(t.orders.select("o_orderstatus"), table, path)
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count"))
    return writers.recreate_table(counts, table, scratch_path(t.spark, "table"))


@query(
    "k_partitioned_write",
    """
SELECT event_id, value, 'run-2024-01-20' AS data_lineage_id, strftime(ts, '%Y-%m-%d') AS usage_date, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_missing
FROM events""",
)
def k_partitioned_write(t: Tables):
    table, path = scratch_table("usage"), scratch_path(t.spark, "partitioned")
    rows = with_lineage(
        t.events.select(
            "event_id", "value", F.to_date("ts").alias("usage_date"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_missing"),
        ),
        RUN_ID,
    )
    writers.write_partitioned(rows, path, ["usage_date", "is_missing"])
    writers.create_partitioned_table(
        t.spark, table, "event_id BIGINT, value DOUBLE, data_lineage_id STRING, usage_date DATE, is_missing INT",
        ["usage_date", "is_missing"], path,
    )
    t.spark.sql(f"MSCK REPAIR TABLE {table}")
    return t.spark.table(table).withColumn("usage_date", day_text("usage_date"))


@query(
    "k_backfill_missing",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS usage_date, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_missing
FROM events WHERE event_type <> 'error' OR CAST(ts AS DATE) BETWEEN DATE '2023-12-26' AND DATE '2024-01-25'""",
)
def k_backfill_missing(t: Tables):
    path = scratch_path(t.spark, "backfill")
    daily = t.events.select("event_id", "event_type", F.to_date("ts").alias("usage_date"))
    on_time = daily.where(F.col("event_type") != "error").drop("event_type").withColumn("is_missing", F.lit(0))
    late = writers.late_rows(daily.where(F.col("event_type") == "error"), "usage_date", "2024-01-25")
    late = late.drop("event_type").withColumn("is_missing", F.lit(1))
    partitions = ["usage_date", "is_missing"]
    writers.write_partitioned(on_time, path, partitions)
    writers.write_partitioned(late, path, partitions, mode="append")
    return readers.read_parquet(t.spark, path).withColumn("usage_date", day_text("usage_date"))


@query(
    "k_slice_audit",
    """
SELECT count(*) AS record_count, 'orders' AS stream, '20240120' AS slice, 'orders.parquet' AS path, '2024-01-21 00:00:00' AS loaded_at, 'run-2024-01-20' AS run_id, '' AS notes FROM orders
UNION ALL SELECT count(*), 'lineitem', '20240120', 'lineitem.parquet', '2024-01-21 00:00:00', 'run-2024-01-20', '' FROM lineitem
UNION ALL SELECT count(*), 'Offers', '20240120', 'events.parquet', '2024-01-21 00:00:00', 'run-2024-01-20', 'documents' FROM events""",
)
def k_slice_audit(t: Tables):
    at = times.ntz("2024-01-21 00:00:00")
    orders = slice_audit(t.orders, "orders", "20240120", "orders.parquet", RUN_ID, at)
    lines = slice_audit(t.lineitem, "lineitem", "20240120", "lineitem.parquet", RUN_ID, at)
    # Documents of at most 64 records each, whatever the size of a user's share.
    docs = t.events.groupBy(F.floor(F.col("event_id") / 64)).agg(F.collect_list("event_id").alias("offers"))
    offers = slice_audit(docs, "Offers", "20240120", "events.parquet", RUN_ID, at, "documents", documents="offers")
    audit = orders.unionByName(lines).unionByName(offers)
    return audit.withColumn("loaded_at", F.date_format("loaded_at", times.SECONDS_FORMAT))
