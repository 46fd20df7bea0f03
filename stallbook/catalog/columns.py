"""Projections, schema operations and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import text, times
from stallbook.operators import projections as p
from stallbook.operators.windows import newest, order_by


@query(
    "p_rename_spec",
    """
SELECT o_orderkey AS order_id, o_custkey AS account_id, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
)
def p_rename_spec(t: Tables):
    renamed = p.rename_by_spec(t.orders, "o_orderkey as order_id, o_custkey AS account_id, o_orderstatus")
    return renamed.withColumn("o_orderdate", day_text("o_orderdate"))


@query("p_select_spec", "SELECT o_orderkey AS order_id, o_custkey AS account_id FROM orders")
def p_select_spec(t: Tables):
    return p.select_by_spec(t.orders, "o_orderkey as order_id, o_custkey AS account_id")


@query(
    "p_missing_columns",
    """
SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_colour, p_size, CAST(NULL AS VARCHAR) AS p_origin FROM part""",
)
def p_missing_columns(t: Tables):
    return p.with_wanted_columns(t.part.drop("p_absent"), ["p_partkey", "p_name", "p_colour", "p_size", "p_origin"])


@query(
    "p_nested_defaults",
    """
SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE '' END AS title, '' AS summary,
       coalesce(CASE WHEN n_chars > 2000 THEN lang END, source, 'none') AS label
FROM documents""",
)
def p_nested_defaults(t: Tables):
    docs = t.documents.select(
        "doc_id", "lang", "source", "n_chars",
        F.struct(F.struct(F.when(F.col("lang") == "en", F.col("source")).alias("title")).alias("en")).alias("languages"),
    )
    return docs.select(
        "doc_id",
        p.field_or_empty(docs, "languages.en.title").alias("title"),
        p.field_or_empty(docs, "languages.en.summary").alias("summary"),
        F.coalesce(F.when(F.col("n_chars") > 2000, F.col("lang")), "source", F.lit("none")).alias("label"),
    )


@query(
    "p_constant_columns",
    """
SELECT p_partkey, p_name, '' AS expiry_date, 'portal' AS data_source, 0 AS is_multi_solution FROM part""",
)
def p_constant_columns(t: Tables):
    constants = {"expiry_date": "", "data_source": "portal", "is_multi_solution": 0}
    return p.with_constants(t.part.select("p_partkey", "p_name"), constants)


@query(
    "p_fill_nulls",
    """
WITH latest AS (
  SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey END AS buyer FROM orders
  QUALIFY row_number() OVER (PARTITION BY buyer ORDER BY o_orderdate DESC, o_orderkey) = 1
)
SELECT c_custkey, coalesce(o_orderstatus, '') AS last_status, coalesce(o_orderkey, -99999) AS last_order,
       coalesce(epoch_us(o_orderdate) // 1000, -1) AS last_millis
FROM customer LEFT JOIN latest ON c_custkey = buyer""",
)
def p_fill_nulls(t: Tables):
    # Only orders of low priority carry their customer.
    placed = t.orders.withColumn("buyer", F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_custkey")))
    latest = newest(placed, ["buyer"], order_by("-o_orderdate", "o_orderkey"))
    joined = t.customer.join(latest, F.col("c_custkey") == F.col("buyer"), "left").select(
        "c_custkey", F.col("o_orderstatus").alias("last_status"), F.col("o_orderkey").alias("last_order"),
        times.millis(F.col("o_orderdate")).alias("last_millis"),
    )
    return p.fill_nulls(joined, ["last_millis"])


@query(
    "p_row_key",
    """
SELECT p_partkey, p_brand || '_' || coalesce(nullif(p_type, 'PROMO'), '') || '_' || coalesce(nullif(p_name, 'red widget'), '') AS row_key
FROM part""",
)
def p_row_key(t: Tables):
    parts = t.part.select(
        "p_partkey", "p_brand", F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        F.nullif("p_name", F.lit("red widget")).alias("p_name"),
    )
    return parts.select("p_partkey", p.row_key("p_brand", "p_type", "p_name").alias("row_key"))


# Nation keys with a canonical name.
NATION_NAMES = {"1": "Alphaland", "3": "Betaland", "5": "Gammaland", "7": "Deltaland", "9": "Epsilonland"}


@query(
    "p_id_override",
    """
SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'Alphaland' WHEN 3 THEN 'Betaland' WHEN 5 THEN 'Gammaland'
         WHEN 7 THEN 'Deltaland' WHEN 9 THEN 'Epsilonland' ELSE n_name END AS publisher_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def p_id_override(t: Tables):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        "c_custkey", text.override_id(F.col("c_nationkey"), NATION_NAMES, F.col("n_name")).alias("publisher_name")
    )


@query(
    "p_classify_first",
    """
SELECT event_id, CASE WHEN CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) >= 90 THEN 'VirtualMachine'
       WHEN value > 60 THEN 'DataService' WHEN event_type = 'purchase' THEN 'AppService' END AS offer_type
FROM events""",
)
def p_classify_first(t: Tables):
    from stallbook.plans.offers import offer_type

    images = F.when(text.number_field(F.col("props"), "k") >= 90, F.col("props"))
    service = F.when(F.col("value") > 60, F.col("value").cast("string"))
    fulfilment = F.when(F.col("event_type") == "purchase", F.col("event_type"))
    return t.events.select("event_id", offer_type(images, service, fulfilment).alias("offer_type"))


@query(
    "p_remap",
    """
SELECT p_partkey, CASE WHEN p_type = 'SMALL' AND p_size > 10 THEN 'AppService B+C' WHEN p_type = 'SMALL' THEN 'AppService'
         WHEN p_type = 'LARGE' THEN 'VirtualMachineService' ELSE p_type END AS offer_type,
       CASE WHEN p_type = 'SMALL' AND p_size > 10 THEN 1 ELSE 0 END AS is_usage_billed
FROM part""",
)
def p_remap(t: Tables):
    from stallbook.plans.offers import is_usage_billed, mapped_offer_type

    kind = F.when(F.col("p_type") == "SMALL", "AppService").when(F.col("p_type") == "LARGE", "VirtualMachine").otherwise(
        F.col("p_type")
    )
    plan = F.when(F.col("p_size") > 10, F.col("p_name"))
    return t.part.select(
        "p_partkey", mapped_offer_type(kind, plan).alias("offer_type"), is_usage_billed(kind, plan).alias("is_usage_billed")
    )


@query(
    "p_bool_text",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END AS flag
FROM lineitem""",
)
def p_bool_text(t: Tables):
    worded = F.when(F.col("l_returnflag") == "A", " true ").when(F.col("l_returnflag") == "R", " 1")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.flag_text(worded).alias("flag")
    )


@query(
    "p_override_or_like",
    """
SELECT d.doc_id, coalesce(l.toxic, CASE WHEN contains(lower(d.text), 'license') OR contains(lower(d.source), 'src1') THEN 1 ELSE 0 END) AS is_internal
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def p_override_or_like(t: Tables):
    from stallbook.plans.publishers import internal_flag

    joined = t.documents.join(t.labels.withColumnRenamed("doc_id", "l_doc"), F.col("doc_id") == F.col("l_doc"), "left")
    flag = internal_flag(F.col("toxic"), {"text": "license", "source": "src1"})
    return joined.select("doc_id", flag.alias("is_internal"))


@query(
    "p_filter_mix",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, p_name
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag IN ('A', 'N') AND l_linenumber NOT IN (3, 7) AND p_name LIKE '%b%' AND p_name NOT LIKE 'red%'
  AND l_quantity BETWEEN 5 AND 45 AND l_linestatus <> 'F' AND l_shipdate IS NOT NULL
  AND l_shipdate >= TIMESTAMP '1996-01-01' AND upper(p_type) <> 'PROMO'""",
)
def p_filter_mix(t: Tables):
    lines = t.lineitem.where(
        F.col("l_returnflag").isin("A", "N")
        & ~F.col("l_linenumber").isin(3, 7)
        & F.col("l_quantity").between(5, 45)
        & (F.col("l_linestatus") != "F")
        & F.col("l_shipdate").isNotNull()
        & (F.col("l_shipdate") >= times.ntz("1996-01-01 00:00:00"))
    )
    parts = t.part.where(
        F.col("p_name").like("%b%") & ~F.col("p_name").like("red%") & (F.upper("p_type") != "PROMO")
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "p_name"
    )
