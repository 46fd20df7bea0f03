"""Domain frames made from the supplied tables, and the same as SQL for the oracles.

Stand-ins: events are order history and daily usage, orders are charges, lineitem is usage
lines, the rest are dimensions. Every frame covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables
from stallbook.functions import text, times
from stallbook.operators.hot import Sort, neighbours
from stallbook.plans.orders import EventNames

EVENT_NAMES = EventNames(
    placed="signup", price_changed="view", cancelled="error", trial_ended="click",
    promotion_ended="purchase", migrated="migrated",
)


def history(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("entry_id"), F.col("user_id").alias("parent_id"),
        F.col("event_type").alias("name"), "ts", F.col("event_id").alias("watermark"),
        F.col("value").alias("price"),
    )


def event_number() -> Column:
    """The number inside an event's properties, as in {"k": 69}."""
    return text.number_field(F.col("props"), "k")


def meter() -> Column:
    """Views and clicks run on cores, ``view2core`` say; other events are plain meters."""
    cores = F.concat("event_type", F.pmod(F.col("user_id"), F.lit(4)).cast("string"), F.lit("core"))
    return F.when(F.col("event_type").isin("view", "click"), cores).otherwise(F.col("event_type"))


METER_SQL = "CASE WHEN event_type IN ('view', 'click') THEN event_type || (user_id % 4) || 'core' ELSE event_type END"


def stray(key: Column, most: float = 100) -> Column:
    """The key where the value is above ``most``, else another key that nothing else has: a provoked miss."""
    return F.when(F.col("value") > most, key).otherwise(-key - 1)


STRAY_SQL = "CASE WHEN value > 100 THEN user_id ELSE -user_id - 1 END"


def price_intervals(t: Tables) -> DataFrame:
    """Price intervals per order and meter from all events.

    Events of a value up to 100 set prices of other orders, which no usage has; some prices are
    set for a time far ahead.
    """
    k = event_number()
    ahead = F.when(k.between(45, 59), 40).otherwise(0)
    priced = t.events.select(
        "event_id", stray(F.col("user_id")).alias("order_id"), meter().alias("meter"),
        (F.col("ts") + F.make_dt_interval(days=ahead)).alias("ts"),
        F.when(k < 15, F.lit(0.0)).otherwise(F.col("value")).alias("price"),
        F.when(k.between(15, 29), "Trial").when(k.between(30, 44), "Promotion").otherwise("None").alias("discount"),
    )
    nexts = neighbours(priced, ["order_id", "meter"], [Sort("ts"), Sort("event_id")], following={"next_ts": "ts"})
    return nexts.select(
        "order_id", "meter", "price", "discount", F.col("ts").alias("start_ts"),
        times.plus_seconds(F.col("next_ts"), -1).alias("end_ts"),
    )


PRICE_INTERVALS_SQL = f"""
price_intervals AS (
  SELECT order_id, {METER_SQL} AS meter,
         CASE WHEN k < 15 THEN 0.0 ELSE value END AS price,
         CASE WHEN k BETWEEN 15 AND 29 THEN 'Trial' WHEN k BETWEEN 30 AND 44 THEN 'Promotion' ELSE 'None' END AS discount,
         start_ts,
         lead(start_ts) OVER (PARTITION BY order_id, event_type ORDER BY start_ts, event_id) - INTERVAL 1 SECOND AS end_ts
  FROM (SELECT *, ts + to_days(CASE WHEN k BETWEEN 45 AND 59 THEN 40 ELSE 0 END) AS start_ts FROM
        (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k, {STRAY_SQL} AS order_id FROM events))
)"""


def known_orders(t: Tables) -> DataFrame:
    """Orders the order service knows: users with a sign-up above 100; other sign-ups name other orders."""
    return t.events.where(F.col("event_type") == "signup").select(stray(F.col("user_id")).alias("order_id")).distinct()


KNOWN_ORDERS_SQL = f"""
known_orders AS (SELECT DISTINCT {STRAY_SQL} AS order_id FROM events WHERE event_type = 'signup')"""


def usage(t: Tables) -> DataFrame:
    """Every event as a usage row; the part number is its type."""
    return t.events.select(
        F.col("user_id").alias("order_id"), meter().alias("meter"), F.col("event_type").alias("part_number"),
        F.to_date("ts").alias("usage_date"), F.col("value").alias("units"), F.col("props").alias("info"),
    )


USAGE_SQL = f"""
usage AS (
  SELECT user_id AS order_id, {METER_SQL} AS meter, event_type AS part_number, CAST(ts AS DATE) AS usage_date,
         value AS units, props AS info FROM events
)"""


CURRENCIES = ["USD", "EUR", "GBP", "JPY", "XXX"]


def currency(key: Column, count: int) -> Column:
    """One of the first ``count`` currencies."""
    names = F.array(*[F.lit(c) for c in CURRENCIES])
    return F.element_at(names, (F.pmod(key, F.lit(count)) + 1).cast("int"))


CURRENCY_SQL = "['USD','EUR','GBP','JPY','XXX'][CAST({key} % {count} AS INTEGER) + 1]"


def rates(t: Tables) -> DataFrame:
    """Exchange rates from purchases: four currencies, several pulls a day."""
    return t.events.where(F.col("event_type") == "purchase").select(
        currency(F.col("user_id"), 4).alias("rate_currency"), F.to_date("ts").alias("rate_day"),
        F.col("ts").alias("pulled"), (F.col("value") / 100).alias("rate"),
    )


RATES_SQL = f"""
rates AS (
  SELECT {CURRENCY_SQL.format(key='user_id', count=4)} AS rate_currency, CAST(ts AS DATE) AS rate_day, ts AS pulled,
         value / 100 AS rate
  FROM events WHERE event_type = 'purchase'
)"""


def charges(t: Tables) -> DataFrame:
    """Orders as charges, their days folded into the month that has rates. The fifth currency has none."""
    shift = F.pmod(F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")), F.lit(30))
    return t.orders.select(
        F.col("o_orderkey").alias("charge_id"), F.col("o_custkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("applies_to"),
        currency(F.col("o_custkey"), 5).alias("currency"),
        F.date_add(F.lit("2024-01-01").cast("date"), shift).alias("charged_on"),
    )


CHARGES_SQL = f"""
charges AS (
  SELECT o_orderkey AS charge_id, o_custkey AS order_id, o_totalprice AS amount, o_orderpriority AS applies_to,
         {CURRENCY_SQL.format(key='o_custkey', count=5)} AS currency,
         CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER) AS DATE) AS charged_on
  FROM orders
)"""


def lines(t: Tables) -> DataFrame:
    """Usage lines: lineitem with part and supplier."""
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


