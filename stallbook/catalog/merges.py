"""Upserts, history and publishing of dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import times
from stallbook.operators import merge as m
from stallbook.operators.windows import Sort
from stallbook.plans.buckets import publish_buckets
from stallbook.plans.publish import publish
from stallbook.session import scratch_path

# The old snapshot and the delta overlap in the second half of 2000.
_OLD = "2001-01-01 00:00:00"
_DELTA = "2000-07-01 00:00:00"


def _keyed(t: Tables, prefix: str = "K"):
    return t.orders.select(
        F.concat(F.lit(prefix), F.col("o_orderkey").cast("string")).alias("row_key"), "o_custkey", "o_totalprice",
        "o_orderstatus", "o_orderdate",
    )


def _old(t: Tables):
    return _keyed(t).where(F.col("o_orderdate") < times.ntz(_OLD)).drop("o_orderdate")


def _delta(t: Tables):
    fresh = _keyed(t, "k").where(F.col("o_orderdate") >= times.ntz(_DELTA)).drop("o_orderdate")
    return fresh.withColumn("o_totalprice", F.col("o_totalprice") * 1.1)


@query(
    "m_scd1_upsert",
    """
SELECT 'k' || o_orderkey AS row_key, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN o_totalprice * CAST(1.1 AS DOUBLE) ELSE o_totalprice END AS o_totalprice, o_orderstatus
FROM orders""",
)
def m_scd1_upsert(t: Tables):
    return m.upsert(_old(t), _delta(t), "row_key")


@query(
    "m_scd2_history",
    """
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
delta AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01')
SELECT 'k' || o.o_orderkey AS row_key, o.o_totalprice AS o_totalprice, '2000-01-01' AS start_day, CASE WHEN d.o_orderkey IS NULL THEN '' ELSE '2001-08-31' END AS end_day
FROM old o LEFT JOIN delta d ON o.o_orderkey = d.o_orderkey
UNION ALL SELECT 'k' || o_orderkey, o_totalprice, '1999-01-01', '1999-12-31' FROM old WHERE o_orderstatus = 'F'
UNION ALL SELECT 'k' || o_orderkey, o_totalprice * CAST(1.1 AS DOUBLE), '2001-09-01', '' FROM delta""",
)
def m_scd2_history(t: Tables):
    def validity(df, start, end):
        return df.withColumns({"start_ts": times.ntz(start), "end_ts": F.lit(end).cast("timestamp_ntz")})

    old = _old(t)
    history = validity(old, "2000-01-01 00:00:00", None).unionByName(
        validity(old.where(F.col("o_orderstatus") == "F"), "1999-01-01 00:00:00", "1999-12-31 00:00:00")
    )
    after = m.extend_history(history, _delta(t), "row_key", times.ntz("2001-09-01 00:00:00"))
    return after.select(
        "row_key", "o_totalprice", day_text("start_ts").alias("start_day"),
        F.coalesce(day_text("end_ts"), F.lit("")).alias("end_day"),
    )


@query(
    "m_first_load_baseline",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""",
)
def m_first_load_baseline(t: Tables):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    delta = t.customer.where(F.col("c_acctbal") >= 0).select(*columns)
    baseline = t.customer.where(F.col("c_acctbal") < 0)
    as_text = baseline.select(*[F.col(c).cast("string").alias(c) for c in reversed(columns)])
    return m.first_load(delta, as_text)


@query(
    "m_publish_dimension",
    """
WITH delta AS (
  SELECT 'k' || o_custkey || o_orderstatus AS row_key, o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'baseline' ELSE 'pubportal' END AS source
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) = 1
), previous AS (
  SELECT 'k' || o_custkey || o_orderstatus AS row_key, o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'baseline' ELSE 'pubportal' END AS source
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) = 1
), merged AS (
  SELECT * FROM previous WHERE row_key NOT IN (SELECT row_key FROM delta) UNION ALL SELECT * FROM delta
)
SELECT lower(row_key) AS row_key, o_custkey, o_orderkey, source
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN source = 'pubportal' THEN 1 ELSE 2 END) AS r FROM merged) WHERE r = 1""",
)
def m_publish_dimension(t: Tables):
    spec = m.DimensionSpec(
        key="row_key", newest_by=(Sort("o_orderdate", True), Sort("o_orderkey")), source="source",
        preferred_source="pubportal", natural_keys=("o_custkey",),
    )
    source = F.when(F.col("o_orderstatus") == "F", "baseline").otherwise("pubportal")
    rows = t.orders.select(
        F.concat(F.lit("K"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("row_key"), "o_custkey",
        "o_orderkey", "o_orderdate", source.alias("source"),
    )
    cut = times.ntz(_DELTA)
    first = m.publish_dimension(
        rows.where(F.col("o_orderdate") < cut), m.DimensionSpec(
            spec.key, spec.newest_by, spec.source, spec.preferred_source, ("o_custkey", "row_key")
        )
    )
    return m.publish_dimension(rows.where(F.col("o_orderdate") >= cut), spec, previous=first).drop("o_orderdate")


@query(
    "m_merge_change_detect",
    """
WITH target AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS o_totalprice
                FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
source AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice
           FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
  CASE WHEN t.o_orderkey IS NULL THEN 'inserted'
       WHEN s.o_orderkey IS NULL OR (t.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus AND t.o_totalprice = s.o_totalprice) THEN 'unchanged'
       ELSE 'updated' END AS action
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey AND t.o_orderpriority = s.o_orderpriority""",
)
def m_merge_change_detect(t: Tables):
    keys, columns = ["o_orderkey", "o_orderpriority"], ["o_orderstatus", "o_totalprice"]
    dated = t.orders.select(*keys, *columns, "o_orderdate")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    target = dated.where(F.col("o_orderdate") < times.ntz(_OLD)).withColumn("o_totalprice", F.col("o_totalprice") + urgent)
    source = dated.where(F.col("o_orderdate") >= times.ntz("1996-01-01 00:00:00")).withColumn(
        "o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))
    )
    return m.merge_changes(target, source, keys, columns, "action")


@query(
    "m_publish_slices",
    """
WITH keyed AS (SELECT *, 'k' || o_custkey || o_orderstatus AS row_key, CASE WHEN o_orderstatus = 'F' THEN 'baseline' ELSE 'pubportal' END AS source FROM orders),
a AS (SELECT * FROM keyed WHERE o_orderdate < TIMESTAMP '2000-07-01' QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY o_orderdate DESC, o_orderkey) = 1),
b AS (SELECT * FROM keyed WHERE o_orderdate >= TIMESTAMP '2000-07-01' QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT lower(a.row_key) AS row_key, a.o_orderkey, '2000-07-01' AS start_day, CASE WHEN b.row_key IS NULL THEN '' ELSE '2001-08-31' END AS end_day
FROM a LEFT JOIN b ON a.row_key = b.row_key
UNION ALL SELECT lower(row_key), o_orderkey, '2001-09-01', '' FROM b""",
)
def m_publish_slices(t: Tables):
    root = scratch_path(t.spark, "dimension")
    spec = m.DimensionSpec(
        "row_key", (Sort("o_orderdate", True), Sort("o_orderkey")), "source", "pubportal", ("o_custkey",)
    )
    source = F.when(F.col("o_orderstatus") == "F", "baseline").otherwise("pubportal")
    rows = t.orders.select(
        F.concat(F.lit("K"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("row_key"), "o_custkey",
        "o_orderkey", "o_orderdate", source.alias("source"),
    )
    cut = times.ntz(_DELTA)
    publish(rows.where(F.col("o_orderdate") < cut), spec, root, 20000701, times.ntz("2000-07-01 00:00:00"))
    _, history = publish(
        rows.where(F.col("o_orderdate") >= cut), spec, root, 20010901, times.ntz("2001-09-01 00:00:00")
    )
    return t.spark.read.parquet(history).select(
        "row_key", "o_orderkey", day_text("start_ts").alias("start_day"),
        F.coalesce(day_text("end_ts"), F.lit("")).alias("end_day"),
    )


_SLICED = """
WITH keyed AS (SELECT *, 'k' || o_custkey || o_orderstatus AS row_key, CASE WHEN o_orderstatus = 'F' THEN 'baseline' ELSE 'pubportal' END AS source FROM orders),
a AS (SELECT * FROM keyed WHERE o_orderdate < TIMESTAMP '2000-07-01' QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY o_orderdate DESC, o_orderkey) = 1),
b AS (SELECT * FROM keyed WHERE o_orderdate >= TIMESTAMP '2000-07-01' QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY o_orderdate DESC, o_orderkey) = 1)"""


def _published_in_buckets(t: Tables):
    """Two runs, the second over the rows from July 2000 on."""
    root = scratch_path(t.spark, "buckets")
    spec = m.DimensionSpec("row_key", (Sort("o_orderdate", True), Sort("o_orderkey")), "source", "pubportal", ("o_custkey",))
    source = F.when(F.col("o_orderstatus") == "F", "baseline").otherwise("pubportal")
    rows = t.orders.select(
        F.concat(F.lit("K"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("row_key"), "o_custkey",
        "o_orderkey", "o_orderdate", source.alias("source"),
    )
    cut = times.ntz(_DELTA)
    publish_buckets(rows.where(F.col("o_orderdate") < cut), spec, root, 20000701, times.ntz("2000-07-01 00:00:00"), buckets=16)
    return publish_buckets(rows.where(F.col("o_orderdate") >= cut), spec, root, 20010901, times.ntz("2001-09-01 00:00:00"), buckets=16)


@query(
    "m_bucketed_upsert",
    f"""{_SLICED},
first AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN source = 'pubportal' THEN 1 ELSE 2 END) AS r FROM a) WHERE r = 1),
merged AS (SELECT row_key, o_custkey, o_orderkey, source FROM first WHERE row_key NOT IN (SELECT row_key FROM b) UNION ALL SELECT row_key, o_custkey, o_orderkey, source FROM b)
SELECT lower(row_key) AS row_key, o_custkey, o_orderkey, source
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN source = 'pubportal' THEN 1 ELSE 2 END) AS r FROM merged) WHERE r = 1""",
)
def m_bucketed_upsert(t: Tables):
    """Current rows, read back from the buckets that the second run wrote and those it refers to."""
    merged, _ = _published_in_buckets(t)
    return merged.read(t.spark, 20010901).select(F.lower("row_key").alias("row_key"), "o_custkey", "o_orderkey", "source")


@query(
    "m_split_history",
    f"""{_SLICED}
SELECT lower(a.row_key) AS row_key, a.o_orderkey, '2000-07-01' AS start_day, CASE WHEN b.row_key IS NULL THEN '' ELSE '2001-08-31' END AS end_day
FROM a LEFT JOIN b ON a.row_key = b.row_key
UNION ALL SELECT lower(row_key), o_orderkey, '2001-09-01', '' FROM b""",
)
def m_split_history(t: Tables):
    """All versions, read back from the open buckets and the folders of closed versions."""
    _, versions = _published_in_buckets(t)
    return versions.read(t.spark, 20010901).select(
        "row_key", "o_orderkey", day_text("start_ts").alias("start_day"), F.coalesce(day_text("end_ts"), F.lit("")).alias("end_day"),
    )
