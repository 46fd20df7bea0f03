"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, day_text, money, query
from stallbook.functions import times
from stallbook.operators import aggregates as a
from stallbook.operators.windows import newest, order_by


@query(
    "a_sum_having",
    """
SELECT p_brand, p_name, CAST(0 AS BIGINT) AS small_items FROM part WHERE p_type <> 'PROMO'
GROUP BY p_brand, p_name HAVING sum(CASE WHEN p_size IN (1, 2) THEN 1 ELSE 0 END) = 0""",
)
def a_sum_having(t: Tables):
    small = F.when(F.col("p_size").isin(1, 2), 1).otherwise(0)
    return a.groups_with_zero_sum(t.part.where(F.col("p_type") != "PROMO"), ["p_brand", "p_name"], small, "small_items")


@query(
    "a_min_event",
    """
SELECT user_id, epoch_us(min(ts)) // 1000 AS cancelled_ms FROM events WHERE event_type = 'error' GROUP BY user_id""",
)
def a_min_event(t: Tables):
    first = a.first_event(t.events, "user_id", "event_type", "error", "ts", "cancelled")
    return first.select("user_id", times.millis(F.col("cancelled")).alias("cancelled_ms"))


@query(
    "a_effective_window",
    """
SELECT user_id, epoch_us(min(ts)) // 1000 AS start_ms,
       epoch_us(coalesce(min(ts) FILTER (event_type = 'error'), TIMESTAMP '9999-01-01')) // 1000 AS end_ms,
       CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 'Active' ELSE 'Cancelled' END AS window_state
FROM events GROUP BY user_id""",
)
def a_effective_window(t: Tables):
    windows = a.effective_window(t.events, "user_id", "event_type", "error", "ts")
    return windows.select(
        "user_id", times.millis(F.col("window_start")).alias("start_ms"),
        times.millis(F.coalesce("window_end", times.open_end())).alias("end_ms"), "window_state",
    )


@query(
    "a_dynamic_groupby",
    """
SELECT l_returnflag, l_linestatus, l_suppkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship
FROM lineitem GROUP BY ALL""",
)
def a_dynamic_groupby(t: Tables):
    return a.group_by_spec(
        t.lineitem, "l_returnflag, l_linestatus,l_suppkey",
        {"first_ship": day_text(F.min("l_shipdate")), "last_ship": day_text(F.max("l_shipdate"))},
    )


@query(
    "a_latest_sum",
    """
SELECT l_orderkey, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r FROM lineitem) WHERE r = 1
GROUP BY l_orderkey, l_returnflag""",
)
def a_latest_sum(t: Tables):
    latest = a.sum_of_latest(t.lineitem, ["l_orderkey"], "l_shipdate", ["l_returnflag"], money("l_extendedprice"), "price")
    return latest.withColumn("price", F.col("price").cast("double"))


@query(
    "a_usage_rollup",
    """
SELECT l_suppkey, s_nationkey, p_brand, p_type, p_size, l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) * p_size AS DOUBLE) AS core_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY l_suppkey, s_nationkey, p_brand, p_type, p_size, l_returnflag, l_linestatus, year(l_shipdate)""",
)
def a_usage_rollup(t: Tables):
    keys = ["l_suppkey", "s_nationkey", "p_brand", "p_type", "p_size", "l_returnflag", "l_linestatus", "ship_year"]
    rows = frames.lines(t).withColumn("ship_year", F.year("l_shipdate"))
    rolled = a.usage_rollup(rows, keys, money("l_quantity"), F.col("p_size"))
    return rolled.withColumns({c: F.col(c).cast("double") for c in ("quantity", "core_quantity")})


@query(
    "a_charge_rollup",
    """
WITH priced AS (
  SELECT o_custkey, o_orderpriority, CASE WHEN n_regionkey = 1 THEN 'USD' ELSE n_name END AS currency,
         CAST(1 + n_regionkey AS DECIMAL(18,4)) / 4 AS fx, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)
SELECT o_custkey, o_orderpriority, currency, CAST(sum(amount) AS DOUBLE) AS amount,
       CASE WHEN currency = 'USD' THEN CAST(sum(amount) AS DOUBLE) ELSE CAST(sum(amount) AS DOUBLE) * CAST(fx AS DOUBLE) END AS amount_usd,
       count(*) AS charges
FROM priced GROUP BY o_custkey, o_orderpriority, currency, fx""",
)
def a_charge_rollup(t: Tables):
    from stallbook.plans.charges import charge_rollup

    priced = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_custkey", "o_orderpriority",
            F.when(F.col("n_regionkey") == 1, "USD").otherwise(F.col("n_name")).alias("currency"),
            ((F.lit(1) + F.col("n_regionkey")) / 4).alias("fx_rate"),
            money("o_totalprice").alias("amount"), F.lit(1).alias("usage_quantity"),
        )
    )
    rolled = charge_rollup(priced, ["o_custkey", "o_orderpriority"])
    return rolled.select(
        "o_custkey", "o_orderpriority", "currency", "amount", "amount_usd",
        F.col("usage_quantity").cast("bigint").alias("charges"),
    )


@query(
    "a_weekly_usage",
    """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type, user_id, 'raw' AS measure,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM events GROUP BY date_trunc('week', ts), event_type, user_id
UNION ALL
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d'), event_type, user_id, 'core',
       CAST(sum(CAST(value AS DECIMAL(18,2)) * CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER)) AS DOUBLE)
FROM events GROUP BY date_trunc('week', ts), event_type, user_id""",
)
def a_weekly_usage(t: Tables):
    from stallbook.plans.insights import weekly_usage

    usage = t.events.select(
        "ts", "event_type", "user_id", money("value").alias("units"), frames.event_number().alias("cores")
    )
    return weekly_usage(usage, "ts", ["event_type", "user_id"]).select(
        day_text("week_start").alias("week_start"), "event_type", "user_id", "measure",
        F.col("quantity").cast("double").alias("quantity"),
    )


@query("a_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linenumber, lower(l_linestatus) AS status FROM lineitem")
def a_distinct(t: Tables):
    return t.lineitem.select(
        "l_suppkey", "l_returnflag", "l_linenumber", F.lower("l_linestatus").alias("status")
    ).distinct()


@query(
    "a_dedup_key",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1""",
)
def a_dedup_key(t: Tables):
    kept = newest(t.lineitem, ["l_orderkey", "l_linenumber"], order_by("-l_shipdate", "l_partkey", "l_suppkey"))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "a_first_seen",
    """
SELECT md5(lower(url)) AS uri_hash, epoch_us(min(ts)) // 1000 AS first_ms FROM events JOIN pages ON page_id = user_id GROUP BY 1""",
)
def a_first_seen(t: Tables):
    from stallbook.plans.orders import multi_resource_orders

    usage = t.events.join(t.pages.select("page_id", "url"), F.col("user_id") == F.col("page_id")).select(
        F.col("url").alias("uri"), F.col("user_id").alias("order_id"), F.col("ts").alias("start_ts")
    )
    return multi_resource_orders(usage).select("uri_hash", times.millis(F.col("purchase_ts")).alias("first_ms"))
