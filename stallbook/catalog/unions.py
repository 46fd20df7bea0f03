"""Unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, query
from stallbook.operators.sets import checked_union, union_distinct


@query(
    "u_checked_union",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def u_checked_union(t: Tables):
    first = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    second = t.supplier.select(
        F.col("s_acctbal").alias("BALANCE"), F.col("s_suppkey").alias("Id"), F.col("s_name").alias("Name")
    )
    return checked_union(first, second)


@query(
    "u_union_all",
    """
SELECT user_id AS order_id, event_type AS usage_type, value AS quantity, 'UsageDaily' AS usage_data_source FROM events WHERE event_type = 'view'
UNION ALL
SELECT user_id, event_type, value * 24, 'CoreUsage' FROM events WHERE event_type = 'click'""",
)
def u_union_all(t: Tables):
    from stallbook.plans.usage import core_quantity

    def of(kind: str, quantity, source: str):
        return frames.usage(t).where(F.col("part_number") == kind).select(
            "order_id", F.col("part_number").alias("usage_type"), quantity.alias("quantity"),
            F.lit(source).alias("usage_data_source"),
        )

    units = F.col("units")
    return of("view", units, "UsageDaily").unionByName(of("click", core_quantity(units), "CoreUsage"))


@query(
    "u_union_distinct",
    """
SELECT p_brand AS size_name, p_type AS vm_type, p_size AS cores FROM part
UNION SELECT p_brand, 'linux', CAST(p_size AS INTEGER) FROM part WHERE p_type = 'PROMO'""",
)
def u_union_distinct(t: Tables):
    first = t.part.select(F.col("p_brand").alias("size_name"), F.col("p_type").alias("vm_type"), F.col("p_size").alias("cores"))
    second = t.part.where(F.col("p_type") == "PROMO").select(
        F.col("p_brand").alias("size_name"), F.lit("linux").alias("vm_type"), F.col("p_size").cast("string").alias("cores")
    )
    return union_distinct(first, second)
