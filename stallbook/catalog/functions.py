"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, query, second_text
from stallbook.functions import nested, states, text, times
from stallbook.operators.hot import Sort, neighbours
from stallbook.operators.joins import lookup


@query(
    "f_case_trim",
    """
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower, trim('  ' || p_type || ' ') AS type_trimmed
FROM part""",
)
def f_case_trim(t: Tables):
    padded = F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower"),
        F.trim(padded).alias("type_trimmed"),
    )


@query(
    "f_substring",
    """
SELECT c_custkey, substr(c_name, 1, 8) AS head, right(c_name, 9) AS tail,
       CASE WHEN length(c_mktsegment) > 8 THEN right(c_mktsegment, 8) ELSE c_mktsegment END AS segment_tail
FROM customer WHERE length(c_mktsegment) >= 9""",
)
def f_substring(t: Tables):
    return t.customer.where(F.length("c_mktsegment") >= 9).select(
        "c_custkey", F.substring("c_name", 1, 8).alias("head"), text.right_part(F.col("c_name"), 9).alias("tail"),
        text.right_part(F.col("c_mktsegment"), 8).alias("segment_tail"),
    )


def _size_info():
    described = F.concat(F.lit('{"ServiceType": "Std_'), F.col("event_type"), F.lit('", "note": "'), "props", F.lit('"}'))
    return F.when(F.col("event_type") == "error", F.col("props")).otherwise(described)


@query(
    "f_text_between",
    """
SELECT event_id, CASE WHEN event_type <> 'error' THEN 'Std_' || event_type END AS vm_size,
       CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k
FROM events""",
)
def f_text_between(t: Tables):
    return t.events.select(
        "event_id", text.quoted_field(_size_info()).alias("vm_size"), text.number_field(F.col("props"), "k").alias("k")
    )


@query(
    "f_cut_marker",
    """
SELECT c_custkey, regexp_replace(c_name || CASE c_mktsegment WHEN 'BUILDING' THEN '-646-preview' WHEN 'MACHINERY' THEN '-preview2' ELSE '' END,
       '(-646|-preview).*$', '') AS identifier
FROM customer""",
)
def f_cut_marker(t: Tables):
    suffix = F.when(F.col("c_mktsegment") == "BUILDING", "-646-preview").when(
        F.col("c_mktsegment") == "MACHINERY", "-preview2"
    ).otherwise("")
    return t.customer.select("c_custkey", text.cut_at_marker(F.concat("c_name", suffix)).alias("identifier"))


@query(
    "f_after_separator",
    """
SELECT p_partkey,
  coalesce(CASE p_type WHEN 'PROMO' THEN p_brand WHEN 'ECONOMY' THEN NULL ELSE p_name END,
           CASE WHEN p_size > 25 THEN p_type END, p_brand, '') || CASE WHEN p_type = 'SMALL' THEN ' USER' ELSE '' END AS sku
FROM part""",
)
def f_after_separator(t: Tables):
    image = (
        F.when(F.col("p_type") == "PROMO", F.col("p_brand"))
        .when(F.col("p_type") == "ECONOMY", F.concat("p_brand", F.lit("__")))
        .otherwise(F.concat("p_brand", F.lit("__"), "p_name"))
    )
    sku = F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("")
    chosen = F.coalesce(text.after_separator(image), text.first_filled(sku, F.col("p_brand")), F.lit(""))
    return t.part.select(
        "p_partkey", F.concat(chosen, F.when(F.col("p_type") == "SMALL", " USER").otherwise("")).alias("sku")
    )


@query(
    "f_regex_replace",
    """
SELECT event_id, regexp_replace(props, '[{}" ]', '', 'g') AS bare, regexp_replace(event_type || 'v2', 'v2', '_v2', 'g') AS size_name,
       event_type AS family, CAST(event_id AS VARCHAR) AS order_id, replace(event_type || '_' || event_id || '_x', '_', ' ') AS title,
       event_id || '' AS cores
FROM events""",
)
def f_regex_replace(t: Tables):
    key = F.col("event_id").cast("string")
    return t.events.select(
        "event_id",
        F.regexp_replace("props", '[{}" ]', "").alias("bare"),
        F.regexp_replace(F.concat("event_type", F.lit("v2")), "v2", "_v2").alias("size_name"),
        F.regexp_replace(F.lower(F.concat(F.lit("IaaS - "), "event_type")), "iaas - ", "").alias("family"),
        text.strip_prefix(F.concat(F.lit("MONITORING-"), key), "MONITORING-").alias("order_id"),
        F.regexp_replace(F.concat_ws("_", "event_type", key, F.lit("x")), "_", " ").alias("title"),
        F.regexp_replace(F.concat(key, F.lit("core")), "core", "").alias("cores"),
    )


@query(
    "f_core_count",
    """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 0.1666 WHEN 'ECONOMY' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS cores,
       CASE WHEN p_type NOT IN ('PROMO', 'ECONOMY') THEN p_size || 'core' END AS meter
FROM part""",
)
def f_core_count(t: Tables):
    named = (
        F.when(F.col("p_type") == "PROMO", F.lit("SharedCore"))
        .when(F.col("p_type") == "ECONOMY", F.col("p_brand"))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("CORE")))
    )
    cores = text.core_count(named)
    whole = F.when(cores >= 1, cores)
    return t.part.select("p_partkey", cores.cast("double").alias("cores"), text.core_meter(whole).alias("meter"))


@query("f_md5", "SELECT page_id, md5(lower(url)) AS uri_hash FROM pages")
def f_md5(t: Tables):
    return t.pages.select("page_id", text.lower_md5(F.col("url")).alias("uri_hash"))


@query(
    "f_like_classify",
    """
SELECT page_id, CASE WHEN lower(url) LIKE '%m.%example%' AND contains(lower(url), 'blog.') THEN 'RDFE'
                     WHEN contains(lower(url), 'blog.') THEN 'RDFE'
                     WHEN contains(lower(url), '/en/') THEN 'CRP' ELSE 'Unknown' END AS stack,
       CASE WHEN lower(url) LIKE '%utm\\_source=%' ESCAPE '\\' THEN 1 ELSE 0 END AS tracked,
       CASE WHEN lower(url) LIKE '%example%html%' THEN 1 ELSE 0 END AS is_html
FROM pages""",
)
def f_like_classify(t: Tables):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        text.classify_text(url, [("blog.", "RDFE"), ("/en/", "CRP")], "Unknown").alias("stack"),
        text.like_any_case(url, "%utm\\_source=%").cast("int").alias("tracked"),
        text.like_any_case(url, "%example%html%").cast("int").alias("is_html"),
    )


ISO_MILLIS = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}"


@query(
    "f_parse_date",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN -1 ELSE epoch_us(ts) // 1000 END AS at_millis,
       CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS BIGINT) AS at_second,
       strftime(ts, '%Y-%m-%d') AS day
FROM events""",
)
def f_parse_date(t: Tables):
    written = F.concat(F.lit("at "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    written = F.when(F.col("event_type") == "error", F.lit("not known")).otherwise(written)
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id",
        times.parse_millis(written, ISO_MILLIS, times.MILLIS_FORMAT).alias("at_millis"),
        F.floor(times.millis(times.parse_time(plain)) / 1000).alias("at_second"),
        F.date_format(F.to_date(times.parse_time(plain)), "yyyy-MM-dd").alias("day"),
    )


@query(
    "f_format_date",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE
       strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') END AS shown,
       CASE WHEN event_type = 'error' THEN -1 ELSE epoch_us(ts) // 1000 END AS at_long
FROM events""",
)
def f_format_date(t: Tables):
    at = F.when(F.col("event_type") == "error", F.lit(times.MISSING_MILLIS)).otherwise(times.millis(F.col("ts")))
    return t.events.select("event_id", times.format_millis(at).alias("shown"), at.cast("bigint").alias("at_long"))


@query(
    "f_day_bounds",
    f"""
WITH {frames.PRICE_INTERVALS_SQL}
SELECT order_id, meter, strftime(date_trunc('day', start_ts), '%Y-%m-%d %H:%M:%S') AS day_start,
       strftime(date_trunc('day', coalesce(end_ts, TIMESTAMP '2024-02-01')), '%Y-%m-%d') || ' 23:59:59' AS day_end,
       CAST((epoch_us(coalesce(end_ts, TIMESTAMP '2024-02-01')) - epoch_us(start_ts)) // 1000000 AS BIGINT) AS seconds
FROM price_intervals
WHERE (epoch_us(coalesce(end_ts, TIMESTAMP '2024-02-01')) - epoch_us(start_ts)) // 1000000 > 1""",
)
def f_day_bounds(t: Tables):
    end = F.coalesce("end_ts", times.ntz("2024-02-01 00:00:00"))
    shaped = frames.price_intervals(t).select(
        "order_id", "meter",
        second_text(F.date_trunc("day", "start_ts")).alias("day_start"),
        second_text(times.end_of_day(end)).alias("day_end"),
        times.seconds_between(F.col("start_ts"), end).alias("seconds"),
    )
    return shaped.where(F.col("seconds") > 1)


@query(
    "f_after_cancel",
    """
SELECT e.event_id, CASE WHEN CAST(ts AS DATE) > CAST(cancelled AS DATE) THEN 1 ELSE 0 END AS after_cancel
FROM events e LEFT JOIN (SELECT user_id, min(ts) AS cancelled FROM (SELECT CASE WHEN value > 40 THEN user_id ELSE -user_id - 1 END AS user_id, ts FROM events WHERE event_type = 'error') GROUP BY 1) c
  ON e.user_id = c.user_id""",
)
def f_after_cancel(t: Tables):
    failed = t.events.where(F.col("event_type") == "error")
    cancelled = failed.groupBy(frames.stray(F.col("user_id"), 40).alias("c_user")).agg(F.min("ts").alias("cancelled"))
    joined = t.events.join(cancelled, F.col("user_id") == F.col("c_user"), "left")
    return joined.select("event_id", times.after_cancel(F.col("ts"), F.col("cancelled")).alias("after_cancel"))


@query(
    "f_price_state",
    f"""
WITH {frames.KNOWN_ORDERS_SQL}, latest AS (
  SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM (SELECT * REPLACE ({frames.STRAY_SQL} AS user_id) FROM events)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1
)
SELECT e.event_id,
  CASE WHEN l.event_id IS NOT NULL AND k >= 30 AND l.value < 130 THEN 'Free'
       WHEN l.event_id IS NOT NULL AND k >= 30 THEN 'Paid'
       WHEN l.event_id IS NOT NULL AND k >= 15 THEN 'Trial'
       WHEN l.event_id IS NOT NULL THEN 'Promotion'
       WHEN o.order_id IS NULL THEN 'OrderAPI Missing Order' ELSE 'OrderAPI Missing Price' END AS state
FROM events e LEFT JOIN latest l ON e.user_id = l.user_id AND e.event_type = l.event_type
LEFT JOIN known_orders o ON e.user_id = o.order_id""",
)
def f_price_state(t: Tables):
    from stallbook.operators.windows import newest, order_by

    k = frames.event_number()
    priced = t.events.withColumn("user_id", frames.stray(F.col("user_id")))
    latest = newest(priced, ["user_id", "event_type"], order_by("-ts", "event_id")).select(
        F.col("user_id").alias("l_user"), F.col("event_type").alias("l_type"), F.lit(True).alias("found"),
        F.when(F.col("value") < 130, F.lit(0.0)).otherwise(F.col("value")).alias("price"),
        F.when(k >= 30, "None").when(k >= 15, "Trial").otherwise("Promotion").alias("discount"),
    )
    known = frames.known_orders(t).select(F.col("order_id").alias("known"), F.lit(True).alias("is_known"))
    joined = lookup(t.events, latest, [("user_id", "l_user"), ("event_type", "l_type")])
    joined = lookup(joined, known, [("user_id", "known")])
    state = states.price_state(
        F.col("found").isNotNull(), F.col("discount"), F.col("price"), F.col("is_known").isNotNull()
    )
    return joined.select("event_id", state.alias("state"))


@query(
    "f_billing_type",
    """
WITH facts AS (
  SELECT o_orderkey, CASE c_mktsegment WHEN 'BUILDING' THEN TRUE WHEN 'MACHINERY' THEN FALSE WHEN 'FURNITURE' THEN FALSE END AS lic,
         CASE WHEN c_acctbal < 1000 THEN TRUE WHEN c_acctbal < 9000 THEN FALSE END AS ext,
         CASE o_orderstatus WHEN 'F' THEN 0.0 WHEN 'O' THEN o_totalprice END AS price,
         CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 WHEN o_orderpriority < '4' THEN 5.0 END AS market
  FROM orders JOIN customer ON o_custkey = c_custkey
)
SELECT o_orderkey,
  CASE WHEN lic OR (lic IS NULL AND ext) THEN 'Free' WHEN price = 0 THEN 'Free' WHEN price > 0 THEN 'Paid'
       WHEN (lic = FALSE OR NOT coalesce(ext, FALSE)) AND market = 0 THEN 'Free'
       WHEN (lic = FALSE OR NOT coalesce(ext, FALSE)) AND market > 0 THEN 'Paid' ELSE 'Unknown' END AS billing,
  CASE WHEN lic IS NULL AND ext THEN 'BYOL' WHEN lic = FALSE OR (lic IS NULL AND NOT coalesce(ext, FALSE)) THEN 'Billed' ELSE 'Unknown' END AS payment
FROM facts""",
)
def f_billing_type(t: Tables):
    segment, balance, priority = F.col("c_mktsegment"), F.col("c_acctbal"), F.col("o_orderpriority")
    licence = F.when(segment == "BUILDING", True).when(segment.isin("MACHINERY", "FURNITURE"), False)
    outside = F.when(balance < 1000, True).when(balance < 9000, False)
    price = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))
    market = F.when(priority == "5-LOW", 0.0).when(priority < "4", 5.0)
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey",
        states.billing_type(licence, outside, price, market).alias("billing"),
        states.payment_type(licence, outside).alias("payment"),
    )


@query(
    "f_license_channel",
    """
WITH facts AS (
  SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_custkey END AS sub, CASE WHEN c_nationkey < 12 THEN TRUE WHEN c_nationkey < 20 THEN FALSE END AS ea,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Direct Enterprise' WHEN 'MACHINERY' THEN 'Indirect Enterprise' END AS channel
  FROM customer
)
SELECT c_custkey, CASE WHEN sub IS NULL THEN 'PAYG' WHEN coalesce(ea, FALSE) AND channel IS NULL THEN 'Direct Enterprise'
       WHEN channel IS NOT NULL THEN channel ELSE 'PAYG' END AS licence
FROM facts""",
)
def f_license_channel(t: Tables):
    channel = states.channel_name(F.col("c_mktsegment"), ["BUILDING"], ["MACHINERY"])
    subscription = F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))
    enterprise = F.when(F.col("c_nationkey") < 12, True).when(F.col("c_nationkey") < 20, False)
    return t.customer.select("c_custkey", states.licence_type(subscription, enterprise, channel).alias("licence"))


@query(
    "f_interval_nudge",
    """
WITH coarse AS (
  SELECT event_id, user_id, date_trunc('hour', ts) + CASE WHEN hour(ts) = 23 THEN INTERVAL '59 minutes 59 seconds' ELSE INTERVAL '0 seconds' END AS moment FROM events
), near AS (
  SELECT *, lag(moment) OVER w AS prev, lead(moment) OVER w AS nxt FROM coarse WINDOW w AS (PARTITION BY user_id ORDER BY moment, event_id)
)
SELECT event_id,
  strftime(CASE WHEN strftime(moment, '%H:%M:%S') = '23:59:59' THEN moment + INTERVAL 1 SECOND
       WHEN moment = prev OR moment = prev + INTERVAL 1 SECOND THEN moment + INTERVAL 2 SECOND ELSE moment END, '%Y-%m-%d %H:%M:%S') AS start_at,
  strftime(CASE WHEN nxt IS NULL THEN TIMESTAMP '9999-01-01' WHEN strftime(nxt, '%H:%M:%S') = '23:59:59' THEN nxt
       WHEN nxt = moment THEN moment + INTERVAL 1 SECOND WHEN nxt = moment + INTERVAL 1 SECOND THEN nxt + INTERVAL 1 SECOND
       ELSE nxt - INTERVAL 1 SECOND END, '%Y-%m-%d %H:%M:%S') AS end_at
FROM near""",
)
def f_interval_nudge(t: Tables):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    late = F.expr("INTERVAL '59:59' MINUTE TO SECOND")
    coarse = t.events.select("event_id", "user_id", F.when(F.hour("ts") == 23, hour + late).otherwise(hour).alias("at"))
    near = neighbours(
        coarse, ["user_id"], [Sort("at"), Sort("event_id")], previous={"prev": "at"}, following={"nxt": "at"},
    )
    return near.select(
        "event_id",
        second_text(times.interval_start(F.col("at"), F.col("prev"))).alias("start_at"),
        second_text(times.interval_end(F.col("at"), F.col("nxt"), times.open_end())).alias("end_at"),
    )


@query(
    "f_array_clean_join",
    """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE replace(p_name, ' ', '|') END AS words FROM part""",
)
def f_array_clean_join(t: Tables):
    words = F.when(F.col("p_type") == "PROMO", F.array(F.lit(" "))).otherwise(
        F.split(F.regexp_replace("p_name", " ", ", ,  "), ",")
    )
    return t.part.select("p_partkey", nested.clean_join(words).alias("words"))


@query(
    "f_struct_join",
    """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_name || '|' || p_brand || '|' || p_type || '|' || p_size || '|' || p_partkey END AS condition
FROM part""",
)
def f_struct_join(t: Tables):
    fields = ["p_name", "p_brand", "p_type", "p_size", "p_partkey"]
    boxed = F.when(F.col("p_type") != "PROMO", F.struct(*fields))
    shaped = t.part.select("p_partkey", boxed.alias("c"))
    return shaped.select("p_partkey", nested.struct_join(F.col("c"), fields).alias("condition"))
