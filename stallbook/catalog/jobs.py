"""Jobs end to end; their stored results are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import composites, dimensions, frames, pipelines
from stallbook.catalog.registry import ORACLES, Tables, day_text, money, query
from stallbook.functions import times
from stallbook.plans import core_usage, jobs, usage
from stallbook.session import scratch_path, stage
from stallbook.sources import readers


@query(
    "x_order_job",
    f"""
-- both published dimensions and the hand-off of subscription ids
WITH {dimensions.TIMELINE_SQL}, dim AS ({ORACLES["x_order_dimension"]}),
resources AS (SELECT '' || user_id AS order_id, 'HTTP://r/' || event_id AS uri FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1),
multi AS (
  SELECT md5(lower(uri)) AS order_id, min(lower(uri)) AS uri, min(ts) AS purchase_ts
  FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'http://M/' ELSE 'HTTP://m/' END || (event_id % 50) AS uri, ts, CASE WHEN value >= 50 THEN user_id END AS order_number FROM events)
  WHERE order_number IS NOT NULL GROUP BY md5(lower(uri))
), every AS (
  SELECT d.order_id, d.subscription_id AS sub, d.publisher_name AS publisher, d.offer_name AS offer, make_timestamp(d.purchase_ms * 1000) AS purchase_ts, r.uri, '' AS order_type
  FROM dim d LEFT JOIN resources r ON d.order_id = r.order_id
  UNION ALL SELECT m.order_id, NULL, p_brand, p_name, m.purchase_ts, m.uri, 'MultiSolution' FROM multi m LEFT JOIN part ON m.order_id = md5('http://m/' || p_partkey)
), views AS (SELECT DISTINCT '' || user_id AS order_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
span AS (SELECT o_custkey, max(o_orderdate) FILTER (o_orderpriority = '5-LOW') AS l_end FROM orders GROUP BY 1),
priced AS (
  SELECT user_id || '_' || (epoch_us(start_ts) // 1000) || '_' || (epoch_us(coalesce(end_ts, TIMESTAMP '9999-01-01')) // 1000) AS row_key, entry_id, name
  FROM timeline JOIN customer ON user_id = c_custkey
)
SELECT 'order' AS kind, e.order_id AS row_key, coalesce(publisher, '') AS publisher, coalesce(offer, '') AS offer, coalesce(md5(lower(e.uri)), '') AS uri_hash, order_type AS type,
  CASE WHEN c_custkey IS NULL THEN 'PAYG'
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND s.o_custkey IS NOT NULL AND s.l_end IS NULL THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'Direct Enterprise' ELSE 'Indirect Enterprise' END
       WHEN v.order_id IS NOT NULL THEN 'Direct Enterprise' ELSE 'PAYG' END AS licence_type
FROM every e LEFT JOIN customer c ON e.sub = 'S' || c_custkey LEFT JOIN span s ON c_custkey = s.o_custkey
LEFT JOIN views v ON e.order_id = v.order_id AND CAST(e.purchase_ts AS DATE) = v.day
UNION ALL SELECT 'price', row_key, '', '', '', name, '' FROM (SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY entry_id DESC) = 1)
UNION ALL SELECT DISTINCT 'subscription', sub, '', '', '', '', '' FROM every WHERE sub IS NOT NULL""",
)
def x_order_job(t: Tables):
    sources = jobs.OrderSources(
        frames.history(t).join(dimensions.buyers(t), "parent_id"), dimensions.payers(t), dimensions.order_lookups(t), pipelines.last_steps(t)
    )
    done = jobs.order_job(
        sources, scratch_path(t.spark, "order-job"), 20240601, times.ntz("2024-06-01 00:00:00"), "Subscription", frames.EVENT_NAMES, "FURNITURE"
    )
    none = F.lit("")
    orders = readers.read_parquet(t.spark, done.orders.merged).select(
        F.lit("order").alias("kind"), "row_key", F.coalesce("publisher_name", none).alias("publisher"), F.coalesce("offer_name", none).alias("offer"),
        F.coalesce("uri_hash", none).alias("uri_hash"), F.coalesce("order_type", none).alias("type"), "licence_type",
    )
    blank = [none.alias(c) for c in ("publisher", "offer", "uri_hash")]
    prices = readers.read_parquet(t.spark, done.prices.merged).select(
        F.lit("price").alias("kind"), "row_key", *blank, F.col("event_start_name").alias("type"), none.alias("licence_type")
    )
    handed = readers.read_parquet(t.spark, done.subscriptions).select(
        F.lit("subscription").alias("kind"), F.col("subscription_id").alias("row_key"), *blank, none.alias("type"), none.alias("licence_type")
    )
    return orders.unionByName(prices).unionByName(handed)


@query("x_offer_job", ORACLES["x_dimension_build"])
def x_offer_job(t: Tables):
    """The current slice of the published offer dimension."""
    done = jobs.offer_job(
        dimensions.offer_sources(t), dimensions.BRAND_NAMES, scratch_path(t.spark, "offer-job"), 20240601, times.ntz("2024-06-01 00:00:00")
    )
    return readers.read_parquet(t.spark, done.merged).select(*dimensions.BUILT)


@query(
    "x_usage_job",
    f"""
WITH machines AS ({ORACLES["x_priced_usage"]}), metered AS ({ORACLES["x_priced_usage_other"]}), cores AS ({ORACLES["x_core_orders"]}), multi AS ({ORACLES["x_multi_resource_usage"]}),
every AS (
  SELECT '' || order_id AS row_key, 'Machine' AS usage_type, 'UsageDaily' AS usage_data_source, 1 AS is_vm_usage, 0 AS is_core_image, 0 AS is_multi_solution, state, usage_day,
         CAST(NULL AS VARCHAR) AS vm_size, quantity, core_quantity, md5('http://u/' || (order_id % 50)) AS uri_hash FROM machines
  UNION ALL SELECT '' || order_id, 'Metered', 'UsageDaily', 0, 0, 0, state, usage_day, NULL, quantity, core_quantity, md5('http://u/' || (order_id % 50)) FROM metered
  UNION ALL SELECT vm_id, usage_type, NULL, 1, 1, 0, state, usage_day, vm_size, quantity, core_quantity, NULL FROM cores
  UNION ALL SELECT uri_hash, 'MultiSolution', 'UsageDaily MultiSolution', 0, 0, 1, state, usage_day, vm_size, quantity, core_quantity, uri_hash FROM multi
), prices AS (
  SELECT 'S' || p_size AS size, min(p_retailprice) AS price FROM part GROUP BY 1 UNION ALL SELECT 'A' || p_size, min(p_retailprice) FROM part GROUP BY 1
)
SELECT row_key, usage_type, coalesce(usage_data_source, '') AS usage_data_source, is_vm_usage, is_core_image, is_multi_solution, state, usage_day, coalesce(vm_size, '') AS vm_size,
  quantity, core_quantity, coalesce(uri_hash, '') AS uri_hash, price AS default_price, quantity * price AS influenced_cost, coalesce('S' || c_custkey, '') AS subscription_id, 'run-1' AS run
FROM every LEFT JOIN prices ON vm_size = size LEFT JOIN customer ON row_key = '' || c_custkey""",
)
def x_usage_job(t: Tables):
    """The stored usage fact, after a run that was repeated."""
    intervals = stage(frames.price_intervals(t), "price-intervals")
    none = F.lit(None).cast("string")
    used = frames.usage(t).withColumn("uri", F.concat(F.lit("HTTP://U/"), F.pmod("order_id", F.lit(50)).cast("string")))

    def priced(core_meters: bool, excluded: int | None):
        rows = usage.described_usage(usage.billable(used, "2024-01-03", core_meters, excluded))
        keys = ["order_id", "meter", "usage_date", "part_number", "cores", "uri"]
        at = times.ntz("2024-06-01 00:00:00")
        return usage.priced_usage(rows, intervals, frames.known_orders(t), at, keys, money("units")).withColumn("tags", none)

    steps = usage.UsageSteps(priced(True, None), priced(False, 7), core_usage.machine_profiles(composites.core_records(t)), composites.multi_rolled(t)).staged()
    orders = t.customer.select(
        F.col("c_custkey").cast("string").alias("row_key"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("subscription_id"),
        F.lit(None).cast("timestamp_ntz").alias("cancelled"), none.alias("vm_id"),
    )
    prices = t.part.select(
        F.explode(F.array(F.lit("S"), F.lit("A"))).alias("letter"), "p_size", F.col("p_retailprice").alias("price")
    ).select(
        F.concat("letter", F.col("p_size").cast("string")).alias("vm_size"), F.lit("linux").alias("vm_type"), none.alias("series"),
        F.col("p_size").alias("cores"), none.alias("tier"), "price",
    )
    listed = t.pages.where(F.col("url").contains("/en/")).select(F.md5(F.lower("url")).alias("uri_hash"))
    staging, path = scratch_path(t.spark, "usage-steps"), scratch_path(t.spark, "usage-fact")
    # The steps of a run that is repeated replace those of its first attempt.
    usage.store_steps(steps, staging, "run-1")
    usage.usage_job(steps, orders, prices, listed, staging, path, "run-1")
    fact = readers.read_parquet(t.spark, path)
    empty = F.lit("")
    return fact.select(
        "row_key", "usage_type", F.coalesce("usage_data_source", empty).alias("usage_data_source"), "is_vm_usage", "is_core_image", "is_multi_solution",
        "state", day_text("usage_date").alias("usage_day"), F.coalesce("vm_size", empty).alias("vm_size"), "quantity", "core_quantity",
        F.coalesce("uri_hash", empty).alias("uri_hash"), "default_price", "influenced_cost", F.coalesce("subscription_id", empty).alias("subscription_id"),
        F.col("data_lineage_id").alias("run"),
    )
