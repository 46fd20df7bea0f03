"""Ranking windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables, query
from stallbook.functions import times
from stallbook.operators import windows as w
from stallbook.operators.hot import ranked
from stallbook.operators.windows import order_by


@query(
    "w_rank_spec",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey ASC, l_linenumber DESC, l_partkey DESC) AS rn_desc,
  rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate ASC, l_quantity DESC) AS rank_asc
FROM lineitem""",
)
def w_rank_spec(t: Tables):
    # Rows are written in order before they are ranked: keep what is needed.
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity"
    )
    one = w.rank_by_spec(
        lines, "l_suppkey", "l_shipdate, l_orderkey ASC, l_linenumber, l_partkey desc", "rn_desc"
    )
    two = w.rank_by_spec(
        one, "l_suppkey,l_returnflag", "l_shipdate,l_quantity desc", "rank_asc", ties=True, default_descending=False,
    )
    return two.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rn_desc", "rank_asc")


@query(
    "w_latest_version",
    """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def w_latest_version(t: Tables):
    return w.newest(t.orders, ["o_custkey"], order_by("-o_orderdate", "-o_orderkey")).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


@query(
    "w_latest_per_entity",
    """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def w_latest_per_entity(t: Tables):
    return w.newest(t.events, ["user_id"], order_by("-ts", "-event_id")).select(
        "user_id", "event_id", "event_type", "value"
    )


@query(
    "w_dual_row_number",
    """
SELECT user_id, event_type, event_id, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn,
         row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id) AS rn1 FROM events)
WHERE rn1 = 1""",
)
def w_dual_row_number(t: Tables):
    daily = t.events.select("user_id", "event_type", "event_id", "ts", F.to_date("ts").alias("day"))
    order = order_by("-ts", "event_id")
    kept = w.two_row_numbers(daily, ["user_id", "event_type"], order, ["user_id", "event_type", "day"], order)
    return kept.select("user_id", "event_type", "event_id", "rn")


@query(
    "w_dedup_second",
    """
SELECT event_id, user_id, event_type FROM (
  SELECT *, rank() OVER (PARTITION BY user_id, event_type, date_trunc('second', ts) ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""",
)
def w_dedup_second(t: Tables):
    return w.first_per_second(t.events, ["user_id", "event_type"], "ts", ["event_id"]).select(
        "event_id", "user_id", "event_type"
    )


@query(
    "w_event_sequence",
    """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type DESC, event_id) AS seq FROM events""",
)
def w_event_sequence(t: Tables):
    slim = t.events.select("event_id", "user_id", "ts", "event_type")
    return ranked(slim, ["user_id"], order_by("ts", "-event_type", "event_id"), "seq").select("event_id", "user_id", "seq")


@query(
    "w_price_ranks",
    """
SELECT event_id, user_id, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS order_price_rank,
       rank() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC) AS order_price_per_day_rank
FROM events""",
)
def w_price_ranks(t: Tables):
    from stallbook.plans.orders import price_ranks

    timeline = t.events.select(
        "event_id", F.col("user_id").alias("parent_id"), F.col("event_type").alias("order_id"), F.col("ts").alias("start_ts")
    )
    return price_ranks(timeline).select(
        "event_id", F.col("parent_id").alias("user_id"), "order_price_rank", "order_price_per_day_rank"
    )


@query(
    "w_source_priority",
    """
WITH both_sources AS (
  SELECT o_custkey AS key, 'pubportal' AS source, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_custkey, 'baseline', o_totalprice FROM orders WHERE o_orderstatus <> 'F'
)
SELECT key, source, price FROM (SELECT *, rank() OVER (PARTITION BY key ORDER BY CASE WHEN source = 'pubportal' THEN 1 ELSE 2 END) AS r FROM both_sources)
WHERE r = 1""",
)
def w_source_priority(t: Tables):
    source = F.when(F.col("o_orderstatus") == "F", "pubportal").otherwise("baseline")
    both = t.orders.select(F.col("o_custkey").alias("key"), source.alias("source"), F.col("o_totalprice").alias("price"))
    return w.prefer_source(both, ["key"], "source", "pubportal")


@query(
    "w_conditional_dedup",
    """
WITH flagged AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 40)
SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM flagged)
UNION ALL
SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM flagged)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def w_conditional_dedup(t: Tables):
    flag = (F.col("event_type") == "error") & (F.col("value") > 40)
    kept = w.dedup_flagged_groups(t.events, ["user_id"], flag, ["user_id", "event_type"], order_by("-ts", "event_id"))
    return kept.select("event_id", "user_id", "event_type")


@query(
    "w_last_discount",
    """
SELECT user_id AS order_id, CASE event_type WHEN 'click' THEN 'Trial' ELSE 'Promotion' END AS discount, epoch_us(ts) // 1000 AS end_ms
FROM events WHERE event_type IN ('click', 'purchase')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC, ts DESC, event_id DESC) = 1""",
)
def w_last_discount(t: Tables):
    from stallbook.plans.orders import last_discount

    discount = F.when(F.col("event_type") == "click", "Trial").when(F.col("event_type") == "purchase", "Promotion").otherwise("None")
    timeline = t.events.select(
        F.col("event_id").alias("entry_id"), F.col("user_id").alias("order_id"),
        F.col("event_type").alias("event_end_name"), discount.alias("discount"), F.col("ts").alias("end_ts"),
    )
    return last_discount(timeline).select("order_id", "discount", times.millis(F.col("discount_end")).alias("end_ms"))


