"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import times
from stallbook.operators import joins as j
from stallbook.operators.hot import Sort, neighbours
from stallbook.operators.windows import newest, order_by


@query(
    "j_star_left",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_name, n_name, r_name, p_brand, s_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def j_star_left(t: Tables):
    wide = j.star_left(
        t.lineitem,
        [
            (t.orders, "l_orderkey", "o_orderkey"), (t.customer, "o_custkey", "c_custkey"),
            (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey"),
            (t.part, "l_partkey", "p_partkey"), (t.supplier, "l_suppkey", "s_suppkey"),
        ],
    )
    return wide.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "c_name", "n_name", "r_name",
        "p_brand", "s_name",
    )


@query(
    "j_inner_chain",
    """
SELECT r_name, n_name, c_custkey, o_orderkey, l_linenumber, l_partkey, s_suppkey
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey""",
)
def j_inner_chain(t: Tables):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "c_custkey", "o_orderkey", "l_linenumber", "l_partkey", "s_suppkey")
    )


@query(
    "j_using",
    """
SELECT c_custkey, event_id, c_name, o_orderkey
FROM (SELECT user_id AS c_custkey, event_id FROM events) JOIN customer USING (c_custkey)
LEFT JOIN (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey END AS c_custkey, o_orderkey FROM orders) USING (c_custkey)""",
)
def j_using(t: Tables):
    events = t.events.select(F.col("user_id").alias("c_custkey"), "event_id")
    # Only orders of low priority carry their customer.
    placed = t.orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_custkey")).alias("c_custkey"), "o_orderkey"
    )
    return events.join(t.customer, ["c_custkey"]).join(placed, ["c_custkey"], "left").select(
        "c_custkey", "event_id", "c_name", "o_orderkey"
    )


@query(
    "j_semi",
    """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""",
)
def j_semi(t: Tables):
    recent = t.orders.where(F.col("o_orderdate") >= times.ntz("2001-01-01 00:00:00"))
    return t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "j_anti",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_returnflag = 'R' AND m.l_suppkey = l.l_suppkey
  AND m.l_shipdate = l.l_shipdate AND m.l_quantity = l.l_quantity)""",
)
def j_anti(t: Tables):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_suppkey", "l_shipdate", "l_quantity")
    return t.lineitem.join(returned, ["l_suppkey", "l_shipdate", "l_quantity"], "left_anti").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )


@query(
    "j_inner_plus_unmatched",
    """
SELECT p_partkey, p_name, l_orderkey, l_linenumber, l_suppkey
FROM part LEFT JOIN lineitem ON p_partkey = CASE WHEN l_quantity >= 45 THEN l_partkey END""",
)
def j_inner_plus_unmatched(t: Tables):
    # Small quantities carry no part.
    lines = t.lineitem.withColumn("part_key", F.when(F.col("l_quantity") >= 45, F.col("l_partkey")))
    return j.inner_plus_unmatched(t.part, lines, F.col("p_partkey") == F.col("part_key")).select(
        "p_partkey", "p_name", "l_orderkey", "l_linenumber", "l_suppkey"
    )


@query(
    "j_left_residual_or",
    """
WITH latest AS (
  SELECT user_id, event_id, CASE WHEN value > 10 THEN date_part('month', ts) END AS event_month
  FROM events WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
)
SELECT o_orderkey, event_id FROM orders LEFT JOIN latest ON o_custkey = user_id
WHERE date_part('month', o_orderdate) <> event_month OR event_month IS NULL""",
)
def j_left_residual_or(t: Tables):
    latest = newest(t.events.where(F.col("event_type") == "purchase"), ["user_id"], order_by("-ts", "event_id")).select(
        "user_id", "event_id", F.when(F.col("value") > 10, F.month("ts")).alias("event_month")
    )
    dated = t.orders.withColumn("order_month", F.month("o_orderdate"))
    return j.left_where_differs(
        dated, latest, F.col("o_custkey") == F.col("user_id"), "order_month", "event_month"
    ).select("o_orderkey", "event_id")


@query(
    "j_rank_offset",
    """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type DESC, event_id) AS r FROM events)
SELECT a.event_id, p1.event_id AS prev_id, p2.event_id AS prev2_id, n.event_id AS next_id, n.event_type AS next_type
FROM ranked a LEFT JOIN ranked p1 ON a.user_id = p1.user_id AND a.r - 1 = p1.r
LEFT JOIN ranked p2 ON a.user_id = p2.user_id AND a.r - 2 = p2.r
LEFT JOIN ranked n ON a.user_id = n.user_id AND a.r + 1 = n.r""",
)
def j_rank_offset(t: Tables):
    order = [Sort("ts"), Sort("event_type", True), Sort("event_id")]
    slim = t.events.select("event_id", "user_id", "ts", "event_type")
    near = neighbours(
        slim, ["user_id"], order, previous={"prev_id": "event_id"}, before_previous={"prev2_id": "event_id"},
        following={"next_id": "event_id", "next_type": "event_type"},
    )
    return near.select("event_id", "prev_id", "prev2_id", "next_id", "next_type")


_VIEW_DAYS_SQL = f"""
WITH {frames.PRICE_INTERVALS_SQL}, points AS (
  SELECT event_id, user_id, CAST(ts AS DATE) + INTERVAL '23 hours 59 minutes 59 seconds' AS point FROM events WHERE event_type = 'view'
)
SELECT event_id, user_id, price, discount, epoch_us(start_ts) // 1000 AS start_ms
FROM points {{how}} JOIN (SELECT * FROM price_intervals WHERE meter = 'signup') i
  ON user_id = order_id AND point >= start_ts AND (end_ts IS NULL OR point <= end_ts)"""


def _view_days(t: Tables, how: str):
    points = t.events.where(F.col("event_type") == "view").select(
        "event_id", "user_id", times.end_of_day(F.col("ts")).alias("point")
    )
    in_force = frames.price_intervals(t).where(F.col("meter") == "signup")
    joined = j.interval_join(points, in_force, [("user_id", "order_id")], "point", "start_ts", "end_ts", how)
    return joined.select("event_id", "user_id", "price", "discount", times.millis(F.col("start_ts")).alias("start_ms"))


@query("j_interval_inner", _VIEW_DAYS_SQL.format(how=""))
def j_interval_inner(t: Tables):
    return _view_days(t, "inner")


@query("j_interval_left", _VIEW_DAYS_SQL.format(how="LEFT"))
def j_interval_left(t: Tables):
    return _view_days(t, "left")


@query(
    "j_multi_interval",
    """
WITH windows AS (
  SELECT o_custkey AS custkey, min(o_orderdate) FILTER (o_orderstatus = 'F') AS f_start, max(o_orderdate) FILTER (o_orderstatus = 'F') AS f_end,
         min(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS u_start, max(o_orderdate) FILTER (o_orderpriority = '5-LOW') AS l_end
  FROM orders GROUP BY 1
)
SELECT o_orderkey, custkey FROM orders LEFT JOIN windows ON o_custkey = custkey
  AND (f_start IS NULL OR o_orderdate >= f_start) AND (f_end IS NULL OR o_orderdate <= f_end)
  AND (u_start IS NULL OR o_orderdate >= u_start) AND (l_end IS NULL OR o_orderdate <= l_end)""",
)
def j_multi_interval(t: Tables):
    day, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    windows = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.min(F.when(status == "F", day)).alias("f_start"),
        F.max(F.when(status == "F", day)).alias("f_end"),
        F.min(F.when(priority == "1-URGENT", day)).alias("u_start"),
        F.max(F.when(priority == "5-LOW", day)).alias("l_end"),
    )
    start, end = j.intersect_intervals(["f_start", "u_start"], ["f_end", "l_end"])
    valid = windows.select("custkey", start.alias("valid_from"), end.alias("valid_to"))
    joined = j.interval_join(
        t.orders, valid, [("o_custkey", "custkey")], "o_orderdate", "valid_from", "valid_to", "left"
    )
    return joined.select("o_orderkey", "custkey")


@query(
    "j_asof_rate",
    f"""
WITH {frames.RATES_SQL}, {frames.CHARGES_SQL}
SELECT charge_id, currency, strftime(charged_on, '%Y-%m-%d') AS charged_day,
  coalesce(1 / (SELECT rate FROM rates WHERE rate_currency = currency AND rate_day <= charged_on ORDER BY rate_day DESC, pulled DESC LIMIT 1), 1) AS fx
FROM charges""",
)
def j_asof_rate(t: Tables):
    found = j.asof_lookup(
        frames.charges(t), frames.rates(t), [("currency", "rate_currency")], "charged_on", "rate_day", "rate",
        ["pulled"], "found_rate",
    )
    return found.select(
        "charge_id", "currency", day_text("charged_on").alias("charged_day"),
        F.coalesce(F.try_divide(F.lit(1.0), F.col("found_rate")), F.lit(1.0)).alias("fx"),
    )


@query(
    "j_week_bucket",
    """
WITH weeks AS (SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS week_from FROM events)
SELECT event_id, strftime(week_from, '%Y-%m-%d') AS week_from, strftime(week_from + INTERVAL 6 DAY, '%Y-%m-%d') AS week_to
FROM events JOIN weeks ON CAST(ts AS DATE) >= week_from AND CAST(ts AS DATE) <= week_from + INTERVAL 6 DAY""",
)
def j_week_bucket(t: Tables):
    weeks = t.events.select(j.week_start(F.col("ts")).alias("week_from")).distinct()
    weeks = weeks.withColumn("week_to", F.date_add("week_from", 6))
    return j.join_weeks(t.events, "ts", weeks, "week_from").select(
        "event_id", day_text("week_from").alias("week_from"), day_text("week_to").alias("week_to")
    )


@query(
    "j_case_insensitive",
    """
SELECT o_orderkey, c_custkey, c_name FROM (SELECT o_orderkey, 'CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS id FROM orders)
JOIN customer ON lower(id) = lower(c_name)""",
)
def j_case_insensitive(t: Tables):
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    named = t.orders.select("o_orderkey", F.concat(F.lit("CUSTOMER#"), number).alias("id"))
    return named.join(t.customer, j.case_blind([("id", "c_name")])).select("o_orderkey", "c_custkey", "c_name")


@query(
    "j_null_safe",
    """
WITH keyed AS (SELECT p_partkey, p_retailprice, nullif(p_brand, 'Brand#1') AS b, CASE WHEN p_type = 'SMALL' THEN '' ELSE nullif(p_type, 'PROMO') END AS k FROM part),
exact AS (SELECT b AS eb, k AS ek, count(*) AS exact_rows FROM keyed GROUP BY 1, 2),
loose AS (SELECT coalesce(lower(b), '') AS lb, coalesce(lower(k), '') AS lk, count(*) AS loose_rows FROM keyed GROUP BY 1, 2)
SELECT p_partkey, exact_rows, loose_rows FROM keyed
JOIN exact ON b IS NOT DISTINCT FROM eb AND k IS NOT DISTINCT FROM ek
JOIN loose ON coalesce(lower(b), '') = lb AND coalesce(lower(k), '') = lk""",
)
def j_null_safe(t: Tables):
    keyed = t.part.select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("b"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.nullif("p_type", F.lit("PROMO"))).alias("k"),
    )
    exact = keyed.groupBy(F.col("b").alias("eb"), F.col("k").alias("ek")).agg(F.count(F.lit(1)).alias("exact_rows"))
    text_keys = [F.coalesce(F.lower(c), F.lit("")).alias(f"l{c}") for c in ("b", "k")]
    loose = keyed.groupBy(*text_keys).agg(F.count(F.lit(1)).alias("loose_rows"))
    return (
        keyed.join(exact, j.null_safe([("b", "eb"), ("k", "ek")]))
        .join(loose, j.null_as_empty([("b", "lb"), ("k", "lk")]))
        .select("p_partkey", "exact_rows", "loose_rows")
    )


@query(
    "j_computed_key",
    """
WITH o AS (SELECT c_custkey AS over_key, CAST(4 AS INTEGER) AS over_nation FROM customer WHERE c_acctbal < 0)
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN o ON c_custkey = over_key
JOIN nation ON coalesce(over_nation, c_nationkey) = n_nationkey
JOIN region ON CASE WHEN n_nationkey < 10 THEN n_regionkey ELSE 2 END = r_regionkey""",
)
def j_computed_key(t: Tables):
    moved = t.customer.where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("over_key"), F.lit(4).alias("over_nation")
    )
    region_key = F.when(F.col("n_nationkey") < 10, F.col("n_regionkey")).otherwise(2)
    return (
        t.customer.join(moved, F.col("c_custkey") == F.col("over_key"), "left")
        .join(t.nation, F.coalesce("over_nation", "c_nationkey") == F.col("n_nationkey"))
        .join(t.region, region_key == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


@query(
    "j_fallback",
    """
WITH exact AS (SELECT p_brand AS xb, p_type AS xt, p_size AS xs, max(p_retailprice) AS x_price FROM (SELECT * REPLACE (CASE WHEN p_retailprice > 1000 THEN p_brand END AS p_brand) FROM part) GROUP BY ALL),
loose AS (SELECT p_brand AS lb, p_type AS lt, max(p_retailprice) AS l_price FROM (SELECT * REPLACE (CASE WHEN p_size < 20 THEN p_brand END AS p_brand) FROM part) GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(x_price, l_price) AS list_price
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN exact ON p_brand = xb AND p_type = xt AND p_size = xs
LEFT JOIN loose ON xb IS NULL AND p_brand = lb AND p_type = lt""",
)
def j_fallback(t: Tables):
    price = F.max("p_retailprice")
    exact = t.part.groupBy(
        F.when(F.col("p_retailprice") > 1000, F.col("p_brand")).alias("xb"), F.col("p_type").alias("xt"), F.col("p_size").alias("xs")
    ).agg(price.alias("x_price"))
    loose = t.part.groupBy(
        F.when(F.col("p_size") < 20, F.col("p_brand")).alias("lb"), F.col("p_type").alias("lt")
    ).agg(price.alias("l_price"))
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    brand, kind = F.col("p_brand"), F.col("p_type")
    found = j.fallback_lookup(
        rows, exact, (brand == F.col("xb")) & (kind == F.col("xt")) & (F.col("p_size") == F.col("xs")),
        loose, (brand == F.col("lb")) & (kind == F.col("lt")), "xb", {"list_price": ("x_price", "l_price")},
    )
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "list_price")


@query(
    "j_guarded_dual",
    """
WITH by_size AS (SELECT p_type AS kt, p_size AS ks, min(p_retailprice) AS a_price FROM part GROUP BY ALL),
by_brand AS (SELECT p_brand AS kb, max(p_retailprice) AS b_price FROM part GROUP BY ALL)
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN a_price ELSE b_price END AS list_price, a_price, b_price
FROM part LEFT JOIN by_size ON p_type = 'PROMO' AND p_type = kt AND p_size = ks
LEFT JOIN by_brand ON p_type <> 'PROMO' AND p_brand = kb""",
)
def j_guarded_dual(t: Tables):
    by_size = t.part.groupBy(F.col("p_type").alias("kt"), F.col("p_size").alias("ks")).agg(
        F.min("p_retailprice").alias("a_price")
    )
    by_brand = t.part.groupBy(F.col("p_brand").alias("kb")).agg(F.max("p_retailprice").alias("b_price"))
    promo = F.col("p_type") == "PROMO"
    found = j.guarded_lookup(
        t.part, promo,
        (by_size, [F.col("p_type") == F.col("kt"), F.col("p_size") == F.col("ks")]),
        (by_brand, F.col("p_brand") == F.col("kb")),
    )
    return found.select(
        "p_partkey", F.when(promo, F.col("a_price")).otherwise(F.col("b_price")).alias("list_price"),
        "a_price", "b_price",
    )


@query(
    "j_inline_lookup",
    """
SELECT event_id, label FROM events LEFT JOIN (VALUES ('Click', 'Trial offer'), ('Purchase', 'Promotion'), ('ERROR', 'Failure')) a(alias, label)
  ON lower(alias) = event_type""",
)
def j_inline_lookup(t: Tables):
    labels = t.spark.createDataFrame(
        [("Click", "Trial offer"), ("Purchase", "Promotion"), ("ERROR", "Failure")], "alias string, label string"
    )
    return t.events.join(F.broadcast(labels), F.lower("alias") == F.col("event_type"), "left").select("event_id", "label")


@query(
    "j_match_flag",
    """
SELECT o_orderkey, CASE WHEN user_id IS NULL THEN 0 ELSE 1 END AS is_multi, CASE WHEN user_id IS NULL THEN o_orderstatus ELSE 'Solution' END AS source
FROM orders LEFT JOIN (SELECT DISTINCT CASE WHEN event_type = 'error' AND value > 60 THEN user_id END AS user_id FROM events) ON o_custkey = user_id""",
)
def j_match_flag(t: Tables):
    failed = F.when((F.col("event_type") == "error") & (F.col("value") > 60), F.col("user_id"))
    flagged = j.match_flag(t.orders, t.events, F.col("o_custkey"), failed, "is_multi")
    return flagged.select(
        "o_orderkey", "is_multi", F.when(F.col("is_multi") == 1, "Solution").otherwise(F.col("o_orderstatus")).alias("source")
    )


