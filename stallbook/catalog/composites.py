"""Whole pipelines over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, day_text, money, query
from stallbook.functions import text, times
from stallbook.plans import core_usage, orders, usage
from stallbook.session import stage


@query(
    "x_order_price_timeline",
    """
WITH dedup AS (
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('second', ts) ORDER BY ts, event_id) = 1
), seen AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_name
  FROM dedup WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type DESC, event_id)
), windows AS (
  SELECT user_id, min(ts) AS window_start, min(ts) FILTER (WHERE event_type = 'error') AS window_end
  FROM events GROUP BY user_id
), kept AS (
  SELECT * FROM seen JOIN windows USING (user_id)
  WHERE event_type <> 'error'
    AND (next_ts IS NULL OR window_end IS NULL OR next_ts <= window_end)
    AND (window_end IS NULL OR ts < window_end OR window_start = window_end)
    AND NOT (ts = window_start AND (event_type = 'view' OR coalesce(next_name = 'signup', false)))
), priced AS (
  SELECT event_id AS entry_id, user_id AS parent_id, event_type AS event_start_name, value AS price,
    CASE WHEN coalesce(window_end = next_ts, false) THEN 'Cancelled' WHEN next_name IS NULL THEN 'Active' ELSE next_name END AS event_end_name,
    CASE next_name WHEN 'purchase' THEN 'Promotion' WHEN 'click' THEN 'Trial' ELSE 'None' END AS discount,
    CASE WHEN strftime(ts, '%H:%M:%S') = '23:59:59' THEN ts + INTERVAL 1 SECOND
         WHEN ts = prev_ts OR ts = prev_ts + INTERVAL 1 SECOND THEN ts + INTERVAL 2 SECOND ELSE ts END AS start_ts,
    CASE WHEN next_ts IS NULL THEN window_end
         WHEN strftime(next_ts, '%H:%M:%S') = '23:59:59' THEN next_ts
         WHEN next_ts = ts THEN ts + INTERVAL 1 SECOND
         WHEN next_ts = ts + INTERVAL 1 SECOND THEN next_ts + INTERVAL 1 SECOND
         ELSE next_ts - INTERVAL 1 SECOND END AS end_ts
  FROM kept
), keyed AS (
  SELECT *, epoch_us(start_ts) // 1000 AS start_ms, epoch_us(coalesce(end_ts, TIMESTAMP '9999-01-01')) // 1000 AS end_ms FROM priced
)
SELECT entry_id, parent_id, event_start_name, event_end_name, discount, price, start_ms, end_ms,
       concat_ws('_', parent_id, start_ms, end_ms) AS row_key
FROM keyed
QUALIFY row_number() OVER (PARTITION BY concat_ws('_', parent_id, start_ms, end_ms) ORDER BY entry_id DESC) = 1
""",
)
def x_order_price_timeline(t: Tables):
    timeline = orders.price_timeline(frames.history(t), names=frames.EVENT_NAMES)
    return orders.keyed_prices(timeline).select(
        "entry_id", "parent_id", "event_start_name", "event_end_name", "discount", "price", "start_ms", "end_ms",
        "row_key",
    )


_PRICED_SQL = f"""
WITH {frames.PRICE_INTERVALS_SQL}, {frames.KNOWN_ORDERS_SQL}, {frames.USAGE_SQL}, billed AS (
  -- the usage that the step reads
  SELECT * FROM usage u WHERE usage_date >= DATE '2024-01-03' AND {{meters}}
), per_day AS (
  -- rank 1 per order, meter and start day by end; whole days (reference text of the latest prices)
  SELECT *, CAST(start_ts AS DATE) AS first_day, CAST(end_ts AS DATE) AS last_day FROM price_intervals
  WHERE (epoch_us(coalesce(end_ts, TIMESTAMP '2024-06-01')) - epoch_us(start_ts)) // 1000000 > 1
  QUALIFY row_number() OVER (PARTITION BY order_id, meter, CAST(start_ts AS DATE) ORDER BY end_ts DESC NULLS FIRST, start_ts DESC) = 1
), latest AS (
  -- in force at 23:59:59 of some usage day of the order and meter; the last end wins
  SELECT * FROM per_day l WHERE EXISTS (SELECT 1 FROM billed b WHERE b.order_id = l.order_id AND b.meter = l.meter
    AND b.usage_date >= l.first_day AND (l.last_day IS NULL OR b.usage_date <= l.last_day))
  QUALIFY row_number() OVER (PARTITION BY order_id, meter ORDER BY last_day DESC NULLS FIRST, first_day DESC) = 1
), priced AS (
  SELECT u.*, i.price, i.discount, i.order_id AS found, k.order_id AS known, l.price AS l_price, l.discount AS l_discount,
         TRY_CAST(regexp_extract(u.meter, '(\\d+)core', 1) AS DOUBLE) AS cores
  FROM billed u
  LEFT JOIN price_intervals i ON u.order_id = i.order_id AND u.meter = i.meter
    AND usage_date + INTERVAL '23 hours 59 minutes 59 seconds' >= i.start_ts
    AND (i.end_ts IS NULL OR usage_date + INTERVAL '23 hours 59 minutes 59 seconds' <= i.end_ts)
  LEFT JOIN known_orders k ON u.order_id = k.order_id
  LEFT JOIN latest l ON u.order_id = l.order_id AND u.meter = l.meter
), stated AS (
  SELECT *, CASE WHEN found IS NOT NULL AND discount = 'None' AND price = 0 THEN 'Free' WHEN found IS NOT NULL AND discount = 'None' THEN 'Paid'
                 WHEN found IS NOT NULL THEN discount WHEN known IS NULL THEN 'OrderAPI Missing Order' ELSE 'OrderAPI Missing Price' END AS first_state
  FROM priced
)
SELECT order_id, meter, strftime(usage_date, '%Y-%m-%d') AS usage_day, part_number,
  CASE WHEN first_state <> 'OrderAPI Missing Price' THEN first_state
       WHEN l_discount = 'None' AND l_price = 0 THEN 'Free' WHEN l_discount = 'None' THEN 'Paid' WHEN l_discount IS NOT NULL THEN l_discount
       ELSE first_state END AS state,
  CAST(sum(CAST(units AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(units AS DECIMAL(18,2))) AS DOUBLE) * cores AS core_quantity
FROM stated GROUP BY order_id, meter, usage_date, part_number, state, cores"""


def _priced(t: Tables, core_meters: bool, excluded: int | None):
    rows = usage.described_usage(usage.billable(frames.usage(t), "2024-01-03", core_meters, excluded))
    keys = ["order_id", "meter", "usage_date", "part_number", "cores"]
    intervals = stage(frames.price_intervals(t), "price-intervals")
    priced = usage.priced_usage(
        rows, intervals, frames.known_orders(t), times.ntz("2024-06-01 00:00:00"), keys, money("units")
    )
    quantity = F.col("quantity").cast("double")
    return priced.select(
        "order_id", "meter", day_text("usage_date").alias("usage_day"), "part_number", "state",
        quantity.alias("quantity"), (quantity * F.col("cores")).alias("core_quantity"),
    )


@query("x_priced_usage", _PRICED_SQL.format(meters="contains(u.meter, 'core')"))
def x_priced_usage(t: Tables):
    return _priced(t, True, None)


@query("x_priced_usage_other", _PRICED_SQL.format(meters="NOT contains(u.meter, 'core') AND u.order_id <> 7"))
def x_priced_usage_other(t: Tables):
    return _priced(t, False, 7)


def multi_rolled(t: Tables):
    kind = F.col("event_type")
    words = F.when(kind == "error", "datatransfer").when(kind == "click", "compute sw ").otherwise("compute ")
    pages = t.pages.select("page_id", F.col("url").alias("uri"))
    rows = t.events.join(pages, F.col("user_id") == F.col("page_id")).select(
        "uri", F.to_date("ts").alias("usage_date"), F.col("value").alias("units"), F.col("user_id").alias("order_id"),
        kind.alias("kind"), F.concat(words, "props").alias("info"),
        F.concat(F.lit("S"), frames.event_number().cast("string")).alias("vm_size"),
    )
    billed = rows.where(F.col("kind") == "purchase").join(frames.known_orders(t), "order_id", "left_semi")
    listed = t.pages.where(F.col("url").contains("/en/")).select(F.col("url").alias("uri"))
    unbilled = usage.unbilled_usage(rows, listed, billed, "2024-01-01")
    sizes = t.part.groupBy(F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("vm_size")).agg(
        F.max("p_size").alias("cores")
    )
    keys = ["uri", "usage_date", "vm_size", "info"]
    return usage.multi_resource_usage(unbilled, sizes, keys, money("units"))


@query(
    "x_multi_resource_usage",
    f"""
WITH {frames.KNOWN_ORDERS_SQL}, rows AS (
  SELECT lower(url) AS uri, CAST(ts AS DATE) AS usage_date, value AS units, user_id, event_type,
         CASE event_type WHEN 'error' THEN 'datatransfer' WHEN 'click' THEN 'compute sw ' ELSE 'compute ' END || props AS info,
         'S' || regexp_extract(props, '"k": (\\d+)', 1) AS vm_size
  FROM events JOIN pages ON page_id = user_id
), billed AS (
  SELECT DISTINCT uri, usage_date, units FROM rows WHERE event_type = 'purchase'
    AND user_id IN (SELECT order_id FROM known_orders)
), sizes AS (SELECT 'S' || p_size AS size, max(p_size) AS cores FROM part GROUP BY p_size)
SELECT md5(uri) AS uri_hash, strftime(usage_date, '%Y-%m-%d') AS usage_day, vm_size, state, CAST(quantity AS DOUBLE) AS quantity,
       CAST(quantity * coalesce(cores, 1) AS DOUBLE) AS core_quantity
FROM (SELECT uri, usage_date, vm_size, info, CASE WHEN info LIKE '%compute%sw%' THEN 'Paid' ELSE 'Free' END AS state, sum(CAST(units AS DECIMAL(18,2))) AS quantity
      FROM rows r WHERE contains(uri, '/en/') AND NOT contains(info, 'datatr')
        AND NOT EXISTS (SELECT 1 FROM billed b WHERE b.uri = r.uri AND b.usage_date = r.usage_date AND b.units = r.units)
      GROUP BY uri, usage_date, vm_size, info) LEFT JOIN sizes ON vm_size = size""",
)
def x_multi_resource_usage(t: Tables):
    rolled = multi_rolled(t)
    return rolled.select(
        "uri_hash", day_text("usage_date").alias("usage_day"), "vm_size", "state",
        F.col("quantity").cast("double").alias("quantity"), F.col("core_quantity").cast("double").alias("core_quantity"),
    )


@query(
    "x_first_known_size",
    """
SELECT l_suppkey AS vm_id, p_brand AS uri, l_returnflag AS meter, 'S' || p_size AS vm_size, strftime(l_shipdate, '%Y-%m-%d') AS usage_day
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'SMALL' AND l_quantity <> 0
QUALIFY row_number() OVER (PARTITION BY l_suppkey, p_brand, l_returnflag ORDER BY l_shipdate, 'S' || p_size) = 1""",
)
def x_first_known_size(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("vm_id"), F.col("p_brand").alias("uri"), F.col("l_returnflag").alias("meter"),
        F.when(F.col("p_type") != "SMALL", F.concat(F.lit("S"), F.col("p_size").cast("string"))).alias("vm_size"),
        F.col("l_quantity").alias("quantity"), F.col("l_shipdate").alias("usage_date"),
    )
    sizes = usage.first_known_sizes(rows, ["vm_id", "uri", "meter"], ["vm_size", "usage_date"])
    return sizes.withColumn("usage_day", day_text("usage_date")).drop("usage_date")


def _either_case(column: str):
    """Every other line has the text in lower case, and the empty text for null."""
    return F.when(F.col("l_linenumber") % 2 == 0, F.coalesce(F.lower(column), F.lit(""))).otherwise(F.col(column))


def _fact_usage(t: Tables):
    kind, size = F.col("p_type"), F.col("p_size")
    # Everything that depends on the part alone is worked out once per part.
    parts = t.part.select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("uri"),
        F.when(kind != "SMALL", F.concat(F.lit("Std_"), F.substring("p_name", 1, 1), size.cast("string"))).alias("vm_size"),
        text.lower_md5(F.col("p_brand")).alias("uri_hash"),
        F.when(size > 25, "compute sw").otherwise("compute").alias("info"), size.alias("cores"),
        F.when(kind == "PROMO", F.when(size > 25, "windows_oracle_12c_db_x_ent").otherwise("windows_oracle_12c_wls_std"))
        .otherwise(F.lower("p_type")).alias("os_name"),
        F.when(kind != "LARGE", F.concat(F.lit("IaaS - "), kind)).alias("os_family"),
    )
    return t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("row_key"), _either_case("l_returnflag").alias("meter"),
        F.col("l_quantity").alias("quantity"), F.to_date("l_shipdate").alias("usage_date"),
        F.lit(0).alias("is_multi_solution"), F.lit(usage.DAILY_SOURCE).alias("usage_data_source"),
        F.lit("Paid").alias("state"), _either_case("uri").alias("uri"),
        *[c for c in parts.columns if c not in ("p_partkey", "uri")],
    )


@query(
    "x_usage_fact_final",
    """
WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS row_key, CASE WHEN l_linenumber % 2 = 0 THEN coalesce(lower(nullif(p_brand, 'Brand#1')), '') ELSE nullif(p_brand, 'Brand#1') END AS uri,
         CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END AS meter,
         CASE WHEN p_type <> 'SMALL' THEN 'Std_' || p_name[1] || p_size END AS vm_size, l_quantity AS quantity, CAST(l_shipdate AS DATE) AS usage_date,
         md5(lower(p_brand)) AS uri_hash, CASE WHEN p_size > 25 THEN 'compute sw' ELSE 'compute' END AS info, p_size AS cores,
         CASE WHEN p_type = 'PROMO' THEN CASE WHEN p_size > 25 THEN 'windows_oracle_12c_db_x_ent' ELSE 'windows_oracle_12c_wls_std' END ELSE lower(p_type) END AS os_name,
         CASE WHEN p_type <> 'LARGE' THEN 'IaaS - ' || p_type END AS os_family
  FROM lineitem JOIN part ON l_partkey = p_partkey
), sizes AS (
  -- one row per key as it is joined, so that no usage row finds two
  SELECT * FROM lines WHERE vm_size IS NOT NULL AND quantity <> 0
  QUALIFY row_number() OVER (PARTITION BY row_key, coalesce(lower(uri), ''), coalesce(lower(meter), '') ORDER BY usage_date, vm_size, os_name NULLS FIRST, os_family NULLS FIRST, cores) = 1
), plain AS (SELECT 'Std_' || p_name[1] || p_size AS p_size_name, lower(p_type) AS p_kind, min(p_retailprice) AS p_price FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2),
special AS (SELECT p_name[1] AS series, p_size AS q_cores, CASE WHEN p_size > 25 THEN 'Database Enterprise' ELSE 'Weblogic Server Standard' END AS tier, min(p_retailprice) AS q_price
            FROM part WHERE p_type = 'PROMO' GROUP BY 1, 2, 3),
multi AS (SELECT DISTINCT md5('brand#' || s_nationkey) AS h FROM supplier),
joined AS (
  SELECT u.*, o.o_custkey, o.o_orderstatus, o.o_orderdate, z.vm_size AS z_size, z.os_name AS z_os, z.os_family AS z_family, z.cores AS z_cores,
         coalesce(z.os_name LIKE '%windows\\_oracle%' ESCAPE '\\', false) AS is_special, coalesce(u.vm_size, z.vm_size) AS any_size, m.h
  FROM lines u LEFT JOIN orders o ON u.row_key = CAST(o.o_orderkey AS VARCHAR)
  LEFT JOIN sizes z ON u.row_key = z.row_key AND coalesce(lower(u.uri), '') = coalesce(lower(z.uri), '') AND coalesce(lower(u.meter), '') = coalesce(lower(z.meter), '')
  LEFT JOIN multi m ON lower(u.uri_hash) = m.h
)
SELECT DISTINCT row_key, uri, meter, any_size AS vm_size, quantity, strftime(usage_date, '%Y-%m-%d') AS usage_day, 'S' || o_custkey AS subscription_id,
  CASE WHEN h IS NULL THEN 0 ELSE 1 END AS is_multi_solution, CASE WHEN h IS NULL THEN 'UsageDaily' ELSE 'UsageDaily MultiSolution' END AS usage_data_source,
  CASE WHEN h IS NULL THEN 'Paid' WHEN info = 'compute sw' THEN 'Paid' ELSE 'Free' END AS state,
  CASE WHEN o_orderstatus = 'P' AND usage_date > CAST(o_orderdate + INTERVAL 60 DAY AS DATE) THEN 1 ELSE 0 END AS after_cancel,
  CASE WHEN is_special THEN q_price ELSE p_price END AS default_price,
  quantity * CASE WHEN is_special THEN q_price ELSE p_price END AS influenced_cost, cores, info
FROM joined
LEFT JOIN special ON is_special AND any_size[5] = series AND z_cores = q_cores
  AND tier = CASE WHEN z_os = 'windows_oracle_12c_db_x_ent' THEN 'Database Enterprise' ELSE 'Weblogic Server Standard' END
LEFT JOIN plain ON NOT is_special AND any_size = p_size_name AND coalesce(replace(lower(z_family), 'iaas - ', ''), 'linux') = p_kind""",
)
def x_usage_fact_final(t: Tables):
    rows = stage(_fact_usage(t), "fact-usage")
    order_rows = t.orders.select(
        F.col("o_orderkey").cast("string").alias("row_key"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("subscription_id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")).alias("cancelled"),
        F.concat(F.lit("V"), F.col("o_custkey").cast("string")).alias("vm_id"),
    )
    sizes = usage.first_known_sizes(
        usage.blind_keyed(rows), usage.SIZE_KEYS, ["vm_size", "usage_date", "os_name", "os_family", "cores"]
    )
    promo = F.col("p_type") == "PROMO"
    letter = F.substring("p_name", 1, 1)
    prices = t.part.select(
        F.concat(F.lit("Std_"), letter, F.col("p_size").cast("string")).alias("vm_size"),
        F.when(promo, "Oracle").otherwise(F.lower("p_type")).alias("vm_type"), letter.alias("series"),
        F.col("p_size").alias("cores"),
        F.when(F.col("p_size") > 25, "Database Enterprise").otherwise("Weblogic Server Standard").alias("tier"),
        F.col("p_retailprice").alias("price"),
    )
    multi = t.supplier.select(F.md5(F.concat(F.lit("brand#"), F.col("s_nationkey").cast("string"))).alias("uri_hash"))
    flagged = usage.reflag_multi_resource(rows, multi).drop("os_name", "os_family")
    fact = usage.usage_fact(flagged, usage.FactLookups(order_rows, sizes, prices))
    return fact.select(
        "row_key", "uri", "meter", "vm_size", "quantity", day_text("usage_date").alias("usage_day"), "subscription_id",
        "is_multi_solution", "usage_data_source", "state", "after_cancel", "default_price", "influenced_cost", "cores",
        "info",
    )


@query(
    "x_gov_flag_rank",
    """
WITH located AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, r_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_name, CASE WHEN l_orderkey IN (SELECT l_orderkey FROM located WHERE lower(r_name) LIKE '%asia%') THEN 1 ELSE 0 END AS has_asia,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS location_rank
FROM located""",
)
def x_gov_flag_rank(t: Tables):
    located = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "r_name")
    )
    ties = ["l_linenumber", "l_partkey", "l_suppkey"]
    ranked = usage.usage_locations(located, "l_orderkey", "r_name", "l_shipdate", ties, word="asia")
    return ranked.drop("l_shipdate").withColumnRenamed("in_special_region", "has_asia")


def core_records(t: Tables):
    k, kind = frames.event_number(), F.col("event_type")
    number = k.cast("string")
    publisher = (
        F.when(kind == "view", "Barracuda NG").when(kind == "click", "Oracle Linux").when(kind == "purchase", "Bitnami")
        .when(kind == "signup", "Zulu").otherwise("Other")
    )
    none = F.lit(None).cast("string")
    return t.events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("vm_id"), F.col("event_id").alias("record_id"), "ts",
        kind.alias("location"), F.when(k < 3, "USGov").otherwise("public").alias("cloud"), F.concat(F.lit("A"), number).alias("size"), (k % 5).alias("vp_count"),
        none.alias("subscription_id"), publisher.alias("publisher"), none.alias("data_source"),
        F.lit(1).alias("quantity_vms"), F.lit(24).alias("usage_hours"),
        F.when(kind == "purchase", F.concat(F.lit("img_"), kind, F.lit("__v_"), F.lpad(number, 3, "0"))).alias("image_name"),
        F.concat(F.when(k % 2 == 0, "linux_").otherwise("windows_"), kind).alias("billing_context"),
        F.when(k > 50, "USER").alias("image_type"), none.alias("crp_offer"), none.alias("crp_publisher"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("sku"), number)).alias("crp_sku"),
        publisher.alias("mapped_publisher"),
    )


@query(
    "x_latest_entity_profile",
    """
WITH records AS (
  SELECT 'U' || user_id AS vm_id, event_id, ts, event_type AS location, CASE WHEN k < 3 THEN 'USGov' ELSE 'public' END AS cloud,
    CASE event_type WHEN 'view' THEN 'Barracuda NG' WHEN 'click' THEN 'Oracle Linux' WHEN 'purchase' THEN 'Bitnami' WHEN 'signup' THEN 'Zulu' ELSE 'Other' END AS publisher,
    CASE WHEN event_type = 'purchase' THEN 'img_' || event_type || '__v_' || lpad(CAST(k AS VARCHAR), 3, '0') END AS image_name,
    CASE WHEN k % 2 = 0 THEN 'linux_' ELSE 'windows_' END || event_type AS billing,
    CASE WHEN k > 50 THEN 'USER' END AS image_type, CASE WHEN k % 3 = 0 THEN '' ELSE 'sku' || k END AS sku
  FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events)
), last AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY vm_id ORDER BY ts DESC, event_id DESC) = 1),
meta AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY vm_id ORDER BY image_name DESC NULLS LAST, event_id DESC) = 1),
facts AS (SELECT vm_id, min(ts) AS first_seen, max(CASE WHEN cloud = 'USGov' THEN 1 ELSE 0 END) AS gov FROM records GROUP BY 1),
named AS (
  SELECT l.*, m.billing AS m_billing, f.first_seen, f.gov,
    coalesce(split_part(m.image_name, '__', 2), nullif(m.sku, ''), m.billing, '') || CASE WHEN m.image_type = 'USER' THEN ' USER' ELSE '' END AS full_sku
  FROM last l JOIN meta m USING (vm_id) JOIN facts f USING (vm_id)
)
SELECT vm_id, location, publisher, m_billing AS billing_context, epoch_us(first_seen) // 1000 AS first_ms, gov AS has_used_gov_cloud,
  CASE WHEN m_billing LIKE 'linux%' THEN 'Linux' ELSE 'Windows' END AS os_type, full_sku AS sku,
  publisher || '-' || m_billing AS offer_name, publisher || ':' || m_billing || ':' || full_sku AS plan_key,
  publisher || '-' || replace(m_billing, '_', ' ') || '-' || replace(full_sku, '_', ' ') AS plan_name, vm_id || ':' || m_billing AS order_key,
  CASE WHEN cloud = 'USGov' THEN 1 ELSE 0 END AS is_gov,
  CASE publisher WHEN 'Barracuda NG' THEN 'barracudanetworks' WHEN 'Oracle Linux' THEN 'msopentech' WHEN 'Bitnami' THEN 'Bitnami' WHEN 'Zulu' THEN 'azul' END AS publisher_name
FROM named""",
)
def x_latest_entity_profile(t: Tables):
    profiles = core_usage.machine_profiles(core_records(t))
    return profiles.select(
        "vm_id", "location", "publisher", "billing_context", times.millis(F.col("first_seen")).alias("first_ms"),
        "has_used_gov_cloud", "os_type", "sku", "offer_name", "plan_key", "plan_name", "order_key", "is_gov",
        "publisher_name",
    )


@query(
    "x_core_orders",
    """
WITH last AS (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT 'U' || user_id AS vm_id, event_type AS region, k % 5 AS cores, 'A' || k AS vm_size, CAST(24 AS DOUBLE) AS quantity, CAST(24 AS DOUBLE) AS core_quantity,
  'CORE' AS stack, 'Unknown' AS state, 'CoreOrders' AS usage_type, strftime(ts, '%Y-%m-%d') AS usage_day,
  CASE event_type WHEN 'view' THEN 'barracudanetworks' WHEN 'click' THEN 'msopentech' WHEN 'purchase' THEN 'Bitnami' WHEN 'signup' THEN 'azul' END AS publisher
FROM last""",
)
def x_core_orders(t: Tables):
    rows = usage.core_order_rows(core_usage.machine_profiles(core_records(t)))
    return rows.select(
        "vm_id", "region", "cores", "vm_size", "quantity", "core_quantity", "stack", "state", "usage_type",
        day_text("usage_date").alias("usage_day"), "publisher",
    )


@query(
    "x_core_prices",
    f"""
WITH {frames.PRICE_INTERVALS_SQL}, used AS (
  SELECT DISTINCT (k % 5) || 'core' AS meter, CAST(ts AS DATE) AS day
  FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events) WHERE k % 5 <> 0
)
SELECT DISTINCT order_id, ((order_id % 5 + 5) % 5) || 'core' AS meter, discount, price FROM price_intervals i
WHERE EXISTS (SELECT 1 FROM used u WHERE u.meter = ((i.order_id % 5 + 5) % 5) || 'core' AND CAST(u.day AS TIMESTAMP) >= i.start_ts
  AND (i.end_ts IS NULL OR CAST(u.day AS TIMESTAMP) <= i.end_ts))""",
)
def x_core_prices(t: Tables):
    records = t.events.select((frames.event_number() % 5).alias("vp_count"), "ts")
    sized = F.concat(F.pmod(F.col("order_id"), F.lit(5)).cast("string"), F.lit("core"))
    return usage.core_prices(records, frames.price_intervals(t).withColumn("meter", sized))
