"""Readers. Tables are written in the source's format to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables, day_text, query
from stallbook.session import scratch_path, scratch_table
from stallbook.sources import readers, writers
from stallbook.sources.schema import ColumnSpec, apply_types

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("s_tsv_roundtrip", CUSTOMER_SQL)
def s_tsv_roundtrip(t: Tables):
    path = scratch_path(t.spark, "tsv")
    writers.write_tsv(t.customer.select(*CUSTOMER), path)
    columns = [
        ColumnSpec("c_custkey", "long"), ColumnSpec("c_name"), ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_acctbal", "double"), ColumnSpec("c_mktsegment"),
    ]
    return readers.read_tsv(t.spark, path, columns)


@query(
    "s_typed_cast",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS o_custkey, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 0 END AS urgent,
       CASE WHEN o_orderstatus = 'P' THEN -1 ELSE epoch_us(o_orderdate) // 1000 END AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS o_orderdate_orig
FROM orders""",
)
def s_typed_cast(t: Tables):
    partly = F.col("o_orderstatus") == "P"
    priority = F.col("o_orderpriority")
    as_text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(partly, "12x").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(priority == "1-URGENT", "true").when(priority == "2-HIGH", "False").otherwise("maybe").alias("urgent"),
        F.when(partly, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("o_orderdate"),
    )
    typed = apply_types(as_text, [
        ColumnSpec("o_orderkey", "long"), ColumnSpec("o_custkey", "Int"), ColumnSpec("o_totalprice", "double"),
        ColumnSpec("urgent", "bool"), ColumnSpec("o_orderdate", "date"),
    ])
    return typed.withColumn("urgent", F.col("urgent").cast("int"))


@query("s_json_roundtrip", CUSTOMER_SQL.replace("c_custkey, c_name", "c_custkey AS account_id, c_name"))
def s_json_roundtrip(t: Tables):
    path = scratch_path(t.spark, "json")
    writers.write_snapshot(t.customer, path, "json")
    inferred = readers.read_json(t.spark, path, "c_custkey as account_id")
    return inferred.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query(
    "s_json_explicit",
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""",
)
def s_json_explicit(t: Tables):
    path = scratch_path(t.spark, "json-text")
    writers.write_snapshot(t.customer, path, "json")
    return readers.read_json_text(t.spark, path, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


@query("s_multi_file", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s_multi_file(t: Tables):
    path = scratch_path(t.spark, "files")
    writers.write_snapshot(t.orders.select("o_orderkey", "o_custkey", "o_totalprice").repartition(16, "o_orderkey"), path, "json")
    return readers.read_json(t.spark, path, schema="o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query(
    "s_lookback_days",
    """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS usage_date FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-14' AND CAST(ts AS DATE) <= DATE '2024-01-20'""",
)
def s_lookback_days(t: Tables):
    daily = t.events.withColumn("usage_date", F.to_date("ts"))
    return readers.look_back(daily, "usage_date", "2024-01-20", 6).select(
        "event_id", "user_id", day_text("usage_date").alias("usage_date")
    )


@query(
    "s_latest_publication",
    """
WITH published AS (SELECT *, strftime(ts, '%Y-%m-%d') AS usage_date, strftime(ts, '%H') AS aggregatedts FROM events)
SELECT event_id, usage_date, aggregatedts FROM published
WHERE (usage_date, aggregatedts) IN (SELECT (usage_date, max(aggregatedts)) FROM published GROUP BY usage_date)""",
)
def s_latest_publication(t: Tables):
    published = t.events.select(
        "event_id", day_text("ts").alias("usage_date"), F.date_format("ts", "HH").alias("aggregatedts")
    )
    return readers.latest_publication(published, "usage_date", "aggregatedts")


@query(
    "s_previous_slice",
    """
WITH sliced AS (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS slice FROM orders)
SELECT * FROM sliced WHERE slice = (SELECT max(slice) FROM sliced WHERE slice < '200006')""",
)
def s_previous_slice(t: Tables):
    sliced = t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("slice"))
    return readers.previous_slice(sliced, "slice", F.lit("200006"))


@query(
    "s_explode_docs",
    """
SELECT o_orderkey AS offer_id, o_orderstatus AS offer_type, o_totalprice AS amount, p_name AS title
FROM orders LEFT JOIN part ON o_orderkey = p_partkey""",
)
def s_explode_docs(t: Tables):
    # Documents of at most 64 offers: unlike one per customer, none grows with the data.
    rows = t.orders.join(t.part, F.col("o_orderkey") == F.col("p_partkey"), "left")
    offer = F.struct(
        F.col("o_orderkey").alias("offer_id"), F.col("o_orderstatus").alias("offer_type"),
        F.struct(F.col("o_totalprice").alias("amount"), F.col("p_name").alias("title")).alias("info"),
    )
    docs = rows.groupBy(F.floor(F.col("o_orderkey") / 64)).agg(F.collect_list(offer).alias("offers"))
    offers = readers.explode_documents(docs, "offers")
    return offers.select("offer_id", "offer_type", "info.*")


@query("s_external_table", "SELECT c_custkey, c_name FROM customer")
def s_external_table(t: Tables):
    path = scratch_path(t.spark, "external")
    writers.write_snapshot(t.customer, path, "json")
    schema = "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"
    table = scratch_table("external")
    return readers.external_json_table(t.spark, table, path, schema, ["c_custkey", "c_name"])


@query(
    "s_param_sql",
    """
SELECT l_returnflag, count(*) AS line_count, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY l_returnflag""",
)
def s_param_sql(t: Tables):
    text = """
      SELECT l_returnflag, count(*) AS line_count, date_format(max(l_shipdate), 'yyyy-MM-dd') AS last_ship
      FROM {lineitem_rows} WHERE l_shipdate >= CAST(:first_day AS TIMESTAMP_NTZ) GROUP BY l_returnflag"""
    return readers.named_sql(t.spark, text, {"lineitem_rows": t.lineitem}, first_day="1998-01-01 00:00:00")


