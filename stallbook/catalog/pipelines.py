"""Pipelines in full: charges from text, the stored usage load, order history and dimension with all their sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import times
from stallbook.plans import charges, offers, orders, usage
from stallbook.plans.orders import EventNames
from stallbook.session import scratch_path, stage
from stallbook.sources import readers, writers


def _raw_charges(t: Tables, charge_id, submitted, amount):
    """Charges as they arrive: all columns are text, some unreadable, some with a prefix."""
    key = F.col("charge_id")
    unreadable = F.when(key % 53 == 0, "n/a")
    return frames.charges(t).select(
        F.when(key % 97 == 0, charges.BAD_CHARGES[0]).otherwise(charge_id).alias("charge_id"),
        F.concat(F.when(key % 2 == 0, charges.KEY_PREFIX).otherwise(""), F.lit("O"), F.col("order_id").cast("string")).alias("alternate_order_id"),
        F.concat(submitted.cast("string"), F.lit("T08:15:00")).alias("submitted"),
        F.coalesce(unreadable, amount.cast("string")).alias("amount"), F.lit("1.5").alias("usage_quantity"),
        F.concat(F.col("charged_on").cast("string"), F.lit(" 00:00")).alias("period_start"),
        F.when(key % 7 == 0, "unknown").otherwise(F.col("charged_on").cast("string")).alias("period_end"),
        "applies_to", F.lit("R").alias("region_code"), "currency", F.lit("x").alias("reason_code"),
        F.lit("false").alias("is_deferred"), F.lit(None).cast("string").alias("defer_reason"),
    )


@query(
    "x_charge_fact",
    f"""
-- cleaning, rate, roll-up and merge key after the reference's charge queries
WITH {frames.RATES_SQL}, {frames.CHARGES_SQL}, best AS (
  SELECT * FROM rates QUALIFY row_number() OVER (PARTITION BY rate_currency, rate_day ORDER BY pulled DESC) = 1
), typed AS (
  SELECT *, charge_id % 10 = 0 AS twice, CASE WHEN charge_id % 53 <> 0 THEN amount END AS sum_due FROM charges WHERE charge_id % 97 <> 0
), arrived AS (  -- of a charge submitted twice the later counts
  SELECT 'C' || charge_id AS charge_id, 'O' || order_id AS order_id, applies_to, currency, charged_on, charged_on AS usage_start,
         CASE WHEN charge_id % 7 <> 0 THEN charged_on END AS usage_end, CAST(CAST(sum_due AS DECIMAL(18,4)) AS DOUBLE) AS amount FROM typed
), stored AS (
  SELECT 'C' || charge_id || CASE WHEN applies_to = '5-LOW' THEN '-old' ELSE '' END AS charge_id, 'O' || order_id AS order_id, applies_to, currency,
         CASE WHEN twice THEN CAST(charged_on - INTERVAL 1 DAY AS DATE) ELSE charged_on END AS charged_on, charged_on AS usage_start,
         CASE WHEN charge_id % 7 <> 0 THEN charged_on END AS usage_end, CAST(CAST(CASE WHEN twice THEN sum_due * 2 ELSE sum_due END AS DECIMAL(18,4)) AS DOUBLE) AS amount FROM typed
), a AS (SELECT c.*, coalesce(1 / b.rate, 1) AS fx FROM arrived c ASOF LEFT JOIN best b ON c.currency = b.rate_currency AND c.charged_on >= b.rate_day),
s AS (SELECT c.*, coalesce(1 / b.rate, 1) AS fx FROM stored c ASOF LEFT JOIN best b ON c.currency = b.rate_currency AND c.charged_on >= b.rate_day),
merged AS (
  SELECT coalesce(a.charge_id, s.charge_id) AS charge_id, coalesce(a.applies_to, s.applies_to) AS applies_to, coalesce(a.order_id, s.order_id) AS order_id,
    coalesce(a.charged_on, s.charged_on) AS charged_on, CASE WHEN a.charge_id IS NULL THEN s.usage_end ELSE a.usage_end END AS usage_end, coalesce(a.currency, s.currency) AS currency,
    coalesce(a.fx, s.fx) AS fx_rate, CASE WHEN a.charge_id IS NULL THEN s.amount ELSE a.amount END AS amount,
    CASE WHEN s.charge_id IS NULL THEN 'inserted' WHEN a.charge_id IS NULL THEN 'unchanged' WHEN a.charged_on = s.charged_on THEN 'unchanged' ELSE 'updated' END AS action
  FROM a FULL JOIN s ON a.charge_id = s.charge_id AND a.applies_to = s.applies_to
)
SELECT charge_id, applies_to, order_id, strftime(charged_on, '%Y-%m-%d') AS charged_day, coalesce(strftime(usage_end, '%Y-%m-%d'), '') AS usage_end_day,
  currency, fx_rate, amount, CASE WHEN currency = 'USD' THEN amount ELSE amount * fx_rate END AS amount_usd, action FROM merged""",
)
def x_charge_fact(t: Tables):
    key, day, amount = F.col("charge_id"), F.col("charged_on"), F.col("amount")
    own = F.concat(F.lit("C"), key.cast("string"))
    twice = key % 10 == 0
    latest = _raw_charges(t, own, day, amount)
    # A tenth was also submitted a day earlier with another amount; other rows repeat under an id of their own.
    earlier = _raw_charges(
        t, F.when(twice, own).otherwise(F.lit(charges.BAD_CHARGES[1])), F.date_sub(day, 1), amount * 2
    )
    # What the table holds: the earlier submissions, and low ones under another id.
    old = _raw_charges(
        t, F.when(F.col("applies_to") == "5-LOW", F.concat(own, F.lit("-old"))).otherwise(own),
        F.when(twice, F.date_sub(day, 1)).otherwise(day), F.when(twice, amount * 2).otherwise(amount),
    )
    rates = frames.rates(t)
    fact = charges.charge_fact(charges.clean_charges(latest.unionByName(earlier)), rates)
    target = charges.charge_fact(charges.clean_charges(old), rates)
    return charges.merge_charges(target, fact).select(
        "charge_id", "applies_to", "order_id", day_text("charged_on").alias("charged_day"),
        F.coalesce(day_text("usage_end"), F.lit("")).alias("usage_end_day"), "currency", "fx_rate", "amount", "amount_usd", "action",
    )


_LOAD_SQL = """
WITH daily AS (SELECT event_id, event_type, CAST(ts AS DATE) AS usage_date, strftime(ts, '%H') AS aggregatedts FROM events),
recent AS (SELECT * FROM daily WHERE usage_date > DATE '2024-01-14' AND usage_date <= DATE '2024-01-20'),
newest AS (SELECT usage_date, max(aggregatedts) AS aggregatedts FROM recent GROUP BY usage_date),
loaded AS (
  SELECT event_id, event_type, usage_date, 0 AS is_missing FROM recent JOIN newest USING (usage_date, aggregatedts)
  UNION ALL
  SELECT event_id, event_type, usage_date, 1 FROM daily WHERE event_type = 'error' AND usage_date BETWEEN DATE '2023-12-21' AND DATE '2024-01-20'
)"""


def _stored_load(t: Tables):
    published = t.events.select(
        "event_id", "event_type", F.to_date("ts").alias("usage_date"), F.date_format("ts", "HH").alias("aggregatedts")
    )
    path = scratch_path(t.spark, "usage-load")
    late = published.where(F.col("event_type") == "error")
    at = times.ntz("2024-01-21 00:00:00")
    return path, usage.store_daily_load(published, late, "2024-01-20", 6, "run-2024-01-20", path, at)


@query(
    "x_usage_daily_load",
    f"""{_LOAD_SQL}
SELECT event_id, event_type, strftime(usage_date, '%Y-%m-%d') AS usage_day, is_missing, 'run-2024-01-20' AS data_lineage_id FROM loaded""",
)
def x_usage_daily_load(t: Tables):
    path, _ = _stored_load(t)
    rows = readers.read_parquet(t.spark, path)
    return rows.select("event_id", "event_type", day_text("usage_date").alias("usage_day"), "is_missing", "data_lineage_id")


@query(
    "x_usage_load_audit",
    f"""{_LOAD_SQL}
SELECT count(*) AS record_count, 'Usage' AS stream, '20240120' AS slice, 'run-2024-01-20' AS run_id FROM loaded
UNION ALL SELECT count(*), 'MissingUsage', '20240120', 'run-2024-01-20' FROM loaded WHERE is_missing = 1""",
)
def x_usage_load_audit(t: Tables):
    _, audit = _stored_load(t)
    return audit.select("record_count", "stream", "slice", "run_id")


# A quarter of the users migrate at a purchase.
FULL_NAMES = EventNames(
    placed="signup", price_changed="view", cancelled="error", trial_ended="click", promotion_ended="purchase", migrated="moved"
)
_FULL_HISTORY_SQL = """
h AS (
  SELECT event_id AS entry_id, user_id AS parent_id, CASE WHEN event_type = 'purchase' AND user_id % 4 = 0 THEN 'moved' ELSE event_type END AS name, ts, value AS price,
         CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events
), alternates AS (
  SELECT parent_id, ts, right(long_id, 36) AS order_id FROM (SELECT *, lpad('' || entry_id, CAST(30 + k % 12 AS INTEGER), 'a') AS long_id FROM h WHERE k % 3 = 0) WHERE length(long_id) >= 36
), billing AS (
  SELECT h.parent_id, h.ts, CASE WHEN k % 6 = 0 THEN right(lpad('' || entry_id, CAST(30 + k % 12 AS INTEGER), 'a'), 36) ELSE 'B' || entry_id END AS billing_id,
         CASE WHEN k % 4 = 0 THEN 'EA' ELSE 'DM' END AS billing_system FROM h WHERE k % 2 = 0
), once AS (
  SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY parent_id, name, date_trunc('second', ts) ORDER BY ts, entry_id) = 1
), identified AS (  -- billing rows equal to the order id drop the event
  SELECT o.*, a.order_id, b.billing_id, b.billing_system FROM once o LEFT JOIN alternates a USING (parent_id, ts) LEFT JOIN billing b USING (parent_id, ts)
  WHERE NOT coalesce(a.order_id = b.billing_id, false)
), far AS (
  SELECT *, bool_or(name = 'moved') OVER (PARTITION BY parent_id) AS migrated,
    lag(order_id) OVER w AS o1, lag(order_id, 2) OVER w AS o2, lag(billing_id) OVER w AS b1, lag(billing_id, 2) OVER w AS b2,
    lag(billing_system) OVER w AS s1, lag(billing_system, 2) OVER w AS s2
  FROM identified WINDOW w AS (PARTITION BY parent_id ORDER BY ts, name DESC, entry_id)
), filled AS (
  SELECT entry_id, parent_id, name, ts, price, k, migrated, coalesce(order_id, o1, CASE WHEN NOT migrated THEN o2 END) AS order_id,
    coalesce(billing_id, b1, CASE WHEN NOT migrated THEN b2 END) AS billing_id, coalesce(billing_system, s1, CASE WHEN NOT migrated THEN s2 END) AS billing_system
  FROM far
), done AS (
  SELECT * FROM filled WHERE NOT migrated
  UNION ALL (SELECT * FROM filled WHERE migrated QUALIFY row_number() OVER (PARTITION BY parent_id, order_id, billing_id ORDER BY ts DESC, name DESC, entry_id DESC) = 1)
), seen AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lag(billing_id) OVER w AS prev_b, lag(billing_system) OVER w AS prev_s, lead(ts) OVER w AS next_ts, lead(name) OVER w AS next_name
  FROM done WINDOW w AS (PARTITION BY parent_id ORDER BY ts, name DESC, entry_id)
), windows AS (
  SELECT parent_id, min(ts) AS window_start, min(ts) FILTER (WHERE name = 'error') AS window_end FROM h GROUP BY parent_id
), kept AS (
  SELECT * FROM seen JOIN windows USING (parent_id)
  WHERE name <> 'error' AND (next_ts IS NULL OR window_end IS NULL OR next_ts <= window_end) AND (window_end IS NULL OR ts < window_end OR window_start = window_end)
    AND NOT (ts = window_start AND (name = 'view' OR coalesce(next_name = 'signup', false)))
), meters AS (SELECT entry_id, 'm' || n AS meter, price * n AS metered FROM h, (VALUES (1), (2)) v(n) WHERE k % 5 = 0),
timeline AS (
  SELECT k.entry_id, parent_id, coalesce(order_id, '' || parent_id) AS order_id, name, coalesce(m.meter, 'Monthly') AS meter, CASE WHEN m.meter IS NULL THEN price ELSE metered END AS price,
    CASE WHEN strftime(ts, '%H:%M:%S') = '23:59:59' THEN ts + INTERVAL 1 SECOND WHEN ts = prev_ts OR ts = prev_ts + INTERVAL 1 SECOND THEN ts + INTERVAL 2 SECOND ELSE ts END AS start_ts,
    coalesce(billing_id, prev_b) AS billing_id, coalesce(billing_system, prev_s) AS billing_system
  FROM kept k LEFT JOIN meters m ON k.entry_id = m.entry_id
)"""


def _full_timeline(t: Tables):
    k, key = frames.event_number(), F.col("event_id").cast("string")
    at = [F.col("user_id").alias("parent_id"), "ts"]
    padded = F.lpad(key, (k % 12 + 30).cast("int"), F.lit("a"))
    moved = (F.col("name") == "purchase") & (F.pmod(F.col("parent_id"), F.lit(4)) == 0)
    history = frames.history(t).withColumn("name", F.when(moved, "moved").otherwise(F.col("name")))
    alternates = orders.alternate_ids(t.events.where(k % 3 == 0).select(*at, padded.alias("alternate_id")))
    billing = t.events.where(k % 2 == 0).select(
        *at, F.when(k % 6 == 0, F.right(padded, F.lit(36))).otherwise(F.concat(F.lit("B"), key)).alias("billing_id"),
        F.when(k % 4 == 0, "EA").otherwise("DM").alias("billing_system"),
    )
    metered = t.events.where(k % 5 == 0).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.col("n").alias("meter_id"), F.col("event_id").alias("entry_id"),
        F.concat(F.lit("m"), F.col("n").cast("string")).alias("meter"), (F.col("value") * F.col("n")).alias("amount"),
    )
    return orders.price_timeline(history, alternates, billing, metered, FULL_NAMES)


@query(
    "x_order_history_full",
    f"""
-- alternate ids, external billing, fill-down from two rows, migrated parents, metered prices
WITH {_FULL_HISTORY_SQL}
SELECT entry_id, parent_id, order_id, name AS event_start_name, meter, price, epoch_us(start_ts) // 1000 AS start_ms, coalesce(billing_id, '') AS billing_id,
  coalesce(billing_system, '') AS billing_system FROM timeline""",
)
def x_order_history_full(t: Tables):
    none = F.lit("")
    return _full_timeline(t).select(
        "entry_id", "parent_id", "order_id", "event_start_name", "meter", "price", times.millis(F.col("start_ts")).alias("start_ms"),
        F.coalesce("billing_id", none).alias("billing_id"), F.coalesce("billing_system", none).alias("billing_system"),
    )


def last_steps(t: Tables):
    """Frames of the last steps; templates are named after parts."""
    number = F.col("event_id").cast("string")
    resources = t.events.select(
        F.col("user_id").cast("string").alias("order_id"), F.concat(F.lit("HTTP://r/"), number).alias("uri"), F.col("ts").alias("updated_ts")
    )
    host = F.when(F.col("event_id") % 2 == 0, "http://M/").otherwise("HTTP://m/")
    solution_usage = t.events.select(
        F.concat(host, (F.col("event_id") % 50).cast("string")).alias("uri"),
        F.when(F.col("value") >= 50, F.col("user_id")).alias("order_id"), F.col("ts").alias("start_ts"),
    )
    billing = t.events.where(F.col("event_type") == "view").select(
        F.col("user_id").cast("string").alias("order_id"), F.lit("EA").alias("billing_system"), "ts"
    )
    subscription = F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("subscription_id")
    subscriptions = t.customer.select(F.col("c_custkey").alias("subscription_key"), subscription)
    open_day = F.lit(None).cast("date")
    spans = t.orders.groupBy(F.col("o_custkey").alias("account_id")).agg(
        F.max(F.when(F.col("o_orderpriority") == "5-LOW", F.to_date("o_orderdate"))).alias("low_end")
    )
    channels = orders.subscription_channels(
        spans.select("account_id", F.col("account_id").alias("subscription_key"), open_day.alias("starts"), open_day.alias("ends")),
        spans.select("account_id", F.col("account_id").alias("enrollment_id"), open_day.alias("starts"), open_day.alias("ends")),
        subscriptions,
        t.customer.join(spans, F.col("c_custkey") == F.col("account_id")).select(
            F.col("c_custkey").alias("enrollment_id"),
            orders.states.channel_name(F.col("c_mktsegment"), ["BUILDING"], ["MACHINERY"]).alias("channel"),
            open_day.alias("starts"), F.col("low_end").alias("ends"), open_day.alias("amendment_starts"), open_day.alias("amendment_ends"),
        ),
    )
    templates = t.part.select(
        F.concat(F.lit("HTTP://M/"), F.col("p_partkey").cast("string")).alias("template_uri"), F.col("p_brand").alias("publisher"), F.col("p_name").alias("offer")
    )
    return orders.LastSteps(resources, solution_usage, templates, billing, subscriptions, channels, "DM", "EA")


@query(
    "x_order_dimension_full",
    f"""
-- last steps of the order dimension: resource address, multi-resource orders, market subscription, licence
WITH {_FULL_HISTORY_SQL}, headers AS (
  SELECT * FROM (SELECT order_id, parent_id, min(start_ts) AS purchase_ts FROM timeline GROUP BY order_id, parent_id)
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY purchase_ts DESC, parent_id) = 1
), resources AS (
  SELECT '' || user_id AS order_id, 'HTTP://r/' || event_id AS uri FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
), multi AS (
  SELECT md5(lower(uri)) AS order_id, min(lower(uri)) AS uri, min(ts) AS purchase_ts
  FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'http://M/' ELSE 'HTTP://m/' END || (event_id % 50) AS uri, ts, CASE WHEN value >= 50 THEN user_id END AS order_number FROM events)
  WHERE order_number IS NOT NULL GROUP BY md5(lower(uri))
), every AS (
  SELECT h.order_id, h.parent_id, purchase_ts, r.uri, 0 AS is_multi, 'S' || h.parent_id AS sub FROM headers h LEFT JOIN resources r USING (order_id)
  UNION ALL SELECT order_id, NULL, purchase_ts, uri, 1, NULL FROM multi
), market AS (
  SELECT parent_id, billing_id FROM timeline WHERE billing_system = 'DM' QUALIFY row_number() OVER (PARTITION BY parent_id ORDER BY start_ts DESC, entry_id DESC) = 1
), views AS (SELECT DISTINCT '' || user_id AS order_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
span AS (SELECT o_custkey, max(o_orderdate) FILTER (o_orderpriority = '5-LOW') AS l_end FROM orders GROUP BY 1)
SELECT e.order_id, coalesce(e.uri, '') AS uri, coalesce(md5(lower(e.uri)), '') AS uri_hash, is_multi AS is_multi_solution, coalesce(m.billing_id, '') AS market_subscription_id,
  CASE WHEN c_custkey IS NULL THEN 'PAYG'
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND s.o_custkey IS NOT NULL AND s.l_end IS NULL THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'Direct Enterprise' ELSE 'Indirect Enterprise' END
       WHEN v.order_id IS NOT NULL THEN 'Direct Enterprise' ELSE 'PAYG' END AS licence_type,
  coalesce(p_brand, '') AS publisher_name, coalesce(p_name, '') AS offer_name, CASE is_multi WHEN 1 THEN 'MultiSolution' ELSE '' END AS order_type
FROM every e LEFT JOIN part ON is_multi = 1 AND e.order_id = md5('http://m/' || p_partkey) LEFT JOIN market m ON e.parent_id = m.parent_id LEFT JOIN customer c ON e.sub = 'S' || c_custkey LEFT JOIN span s ON c_custkey = s.o_custkey
LEFT JOIN views v ON e.order_id = v.order_id AND CAST(e.purchase_ts AS DATE) = v.day""",
)
def x_order_dimension_full(t: Tables):
    timeline = stage(_full_timeline(t), "timeline")
    parent = F.col("parent_id").cast("string")
    timeline = timeline.withColumn("subscription_id", F.concat(F.lit("S"), parent))
    ordinary = orders.order_headers(timeline, ["order_id", "parent_id", "subscription_id"]).drop("status", "cancel_ts")
    ordinary = ordinary.withColumn("is_multi_solution", F.lit(0))
    last = last_steps(t)
    licensed = orders.complete_dimension(ordinary, timeline, last)
    none = F.lit("")
    return licensed.select(
        "order_id", F.coalesce("uri", none).alias("uri"), F.coalesce("uri_hash", none).alias("uri_hash"), "is_multi_solution",
        F.coalesce("market_subscription_id", none).alias("market_subscription_id"), "licence_type",
        F.coalesce("publisher_name", none).alias("publisher_name"), F.coalesce("offer_name", none).alias("offer_name"), F.coalesce("order_type", none).alias("order_type"),
    )


@query(
    "x_offer_documents",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'B' || o_custkey AS publisher_id, strftime(o_orderdate, '%Y-%m-%d') AS version,
  CASE WHEN o_orderkey % 3 = 0 THEN 'VirtualMachine' WHEN o_orderstatus = 'F' THEN 'DataService' WHEN o_orderstatus = 'O' THEN 'AppService' ELSE '' END AS offer_type
FROM orders""",
)
def x_offer_documents(t: Tables):
    """Offer documents written as files, read with the declared schema, one classified row per offer."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    image = F.struct(F.lit("linux").alias("OperatingSystem"), F.lit("x").alias("OperatingSystemFamily"), F.lit("1").alias("Version"))
    offer = F.struct(
        key.cast("string").alias("Id"), F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("PublisherId"),
        day_text("o_orderdate").alias("Version"), F.when(status == "F", "d").alias("DataServiceId"),
        F.when(status == "O", "f").alias("FulfillmentServiceId"),
        F.when(key % 3 == 0, F.create_map(F.lit("plan"), F.array(image))).alias("VirtualMachineImagesByServicePlan"),
    )
    path = scratch_path(t.spark, "offer-documents")
    # Documents of at most 64 offers.
    writers.write_snapshot(t.orders.groupBy(F.floor(key / 64)).agg(F.collect_list(offer).alias("offers")).select("offers"), path, "json")
    rows = offers.latest_offers(readers.read_documents(t.spark, path, "offers", offers.DOCUMENT_SCHEMA))
    return rows.select(
        F.col("Id").alias("id"), F.col("PublisherId").alias("publisher_id"), F.col("Version").alias("version"),
        F.coalesce("OfferType", F.lit("")).alias("offer_type"),
    )


@query(
    "k_json_append",
    "SELECT event_id, value FROM events UNION ALL SELECT -event_id, value FROM events",
)
def k_json_append(t: Tables):
    path = scratch_path(t.spark, "json-append")
    writers.append_rows(t.events.select("event_id", "value"), path, "json")
    writers.append_rows(t.events.select((-F.col("event_id")).alias("event_id"), "value"), path, "json")
    return readers.read_json(t.spark, path, schema="event_id bigint, value double")


@query(
    "x_price_list_cores",
    """
-- one list from the calculator and the additions, then the cores of unbilled usage by size
WITH listed AS (
  SELECT CASE WHEN contains(lower(p_type || '_' || p_name), 'v2') THEN replace(lower(p_type || '_' || p_name), 'v2', '_v2') ELSE p_type || '_' || p_name END AS vm_size, p_size AS cores, p_retailprice AS price FROM part
  UNION SELECT 'Std_' || p_size, p_size, p_retailprice FROM part
), sizes AS (SELECT vm_size, max(cores) AS cores FROM listed GROUP BY vm_size)
SELECT md5('r' || p_brand) AS uri_hash, 'Std_' || p_size AS vm_size, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) * max(s.cores) AS DOUBLE) AS core_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN sizes s ON s.vm_size = 'Std_' || p_size GROUP BY p_brand, p_size""",
)
def x_price_list_cores(t: Tables):
    number = F.col("p_size").cast("string")
    calculator = t.part.select(
        F.col("p_type").alias("tier"), F.col("p_name").alias("name"), F.lit("linux").alias("vm_type"), F.lit("s").alias("series"),
        F.col("p_size").alias("cores"), F.col("p_retailprice").alias("price"),
    )
    missing = t.part.select(
        F.concat(F.lit("Std_"), number).alias("vm_size"), F.lit("linux").alias("vm_type"), F.lit("s").alias("series"),
        F.col("p_size").alias("cores"), F.lit("t").alias("tier"), F.col("p_retailprice").alias("price"),
    )
    sizes = usage.price_list(calculator, missing).groupBy("vm_size").agg(F.max("cores").alias("cores"))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("r"), "p_brand").alias("uri"), F.concat(F.lit("Std_"), number).alias("vm_size"), F.lit("compute").alias("info"),
        F.col("l_quantity").cast("decimal(18,2)").alias("units"),
    )
    rolled = usage.multi_resource_usage(rows, sizes, ["uri", "vm_size"])
    return rolled.select("uri_hash", "vm_size", F.col("quantity").cast("double").alias("quantity"), F.col("core_quantity").cast("double").alias("core_quantity"))
