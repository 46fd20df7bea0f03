"""Dimension pipelines over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallbook.catalog import frames
from stallbook.catalog.registry import Tables, day_text, query
from stallbook.functions import text, times
from stallbook.plans import enrollment, offers, orders, publishers
from stallbook.session import stage


def _text(column: str):
    return F.col(column).cast("string")


def _line_documents(t: Tables):
    """One nested document per lineitem row: service plans by market, images by plan."""
    rows = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )

    def price(amount: str, effect: str):
        return F.struct(
            F.col(amount).alias("Amount"), F.col("l_linestatus").alias("AppliesTo"), F.lit(effect).alias("Effect")
        )

    def plan(currency, name, *prices):
        return F.struct(currency.alias("CurrencyCode"), name.alias("NaturalIdentifier"), F.array(*prices).alias("PricePlan"))

    by_market = F.map_from_arrays(
        F.array("n_name", F.lit("GLOBAL")),
        F.array(
            F.array(
                plan(F.lit("EUR"), F.col("l_returnflag"), price("l_extendedprice", "Recurring"), price("l_quantity", "Usage")),
                plan(F.lit("GBP"), F.lit("extra"), price("l_quantity", "FreeTrial")),
            ),
            F.array(plan(F.lit("USD"), F.col("l_returnflag"), price("l_extendedprice", "Recurring"))),
        ),
    )
    image = F.struct(
        F.col("n_name").alias("OperatingSystem"), F.col("l_returnflag").alias("OperatingSystemFamily"),
        _text("l_linenumber").alias("Version"),
    )
    by_plan = F.map_from_arrays(F.array(F.lit("small"), "l_linestatus"), F.array(F.array(image, image), F.array(image)))
    return rows.select(
        _text("l_orderkey").alias("Id"), _text("l_partkey").alias("PublisherId"),
        F.col("s_name").alias("PublisherNaturalIdentifier"), _text("l_suppkey").alias("NaturalIdentifier"),
        _text("l_linenumber").alias("Version"), by_market.alias("ServicePlansByMarket"),
        by_plan.alias("VirtualMachineImagesByServicePlan"),
    )


_LINES_SQL = """
WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_partkey AS VARCHAR) AS publisher_id, CAST(l_linenumber AS VARCHAR) AS version,
         n_name, l_returnflag, l_linestatus, l_extendedprice, l_quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""


@query(
    "x_market_price_explode",
    f"""{_LINES_SQL}
SELECT id, publisher_id, version, n_name AS country, l_returnflag AS plan, 'EUR' AS currency, l_extendedprice AS amount, l_linestatus AS applies_to, 'Recurring' AS effect FROM lines
UNION ALL SELECT id, publisher_id, version, n_name, l_returnflag, 'EUR', l_quantity, l_linestatus, 'Usage' FROM lines
UNION ALL SELECT id, publisher_id, version, n_name, 'extra', 'GBP', l_quantity, l_linestatus, 'FreeTrial' FROM lines
UNION ALL SELECT id, publisher_id, version, 'GLOBAL', l_returnflag, 'USD', l_extendedprice, l_linestatus, 'Recurring' FROM lines""",
)
def x_market_price_explode(t: Tables):
    return offers.market_prices(_line_documents(t)).select(
        F.col("Id").alias("id"), F.col("PublisherId").alias("publisher_id"), F.col("Version").alias("version"),
        F.col("Country").alias("country"), F.col("ServicePlanNID").alias("plan"),
        F.col("CurrencyCode").alias("currency"), F.col("PP_Amount").alias("amount"),
        F.col("PP_AppliesTo").alias("applies_to"), F.col("PP_Effect").alias("effect"),
    )


@query(
    "x_offer_images",
    f"""{_LINES_SQL}
SELECT id, publisher_id, 'small' AS plan, n_name AS os, l_returnflag AS family, version FROM lines
UNION ALL SELECT id, publisher_id, 'small', n_name, l_returnflag, version FROM lines
UNION ALL SELECT id, publisher_id, l_linestatus, n_name, l_returnflag, version FROM lines""",
)
def x_offer_images(t: Tables):
    documents = _line_documents(t).withColumnRenamed("Version", "OfferVersion")
    rows = offers.images(documents, ["Id", "PublisherId"])
    return rows.select(
        F.col("Id").alias("id"), F.col("PublisherId").alias("publisher_id"), F.col("ServicePlanName").alias("plan"),
        F.col("OperatingSystem").alias("os"), F.col("OperatingSystemFamily").alias("family"),
        F.col("Version").alias("version"),
    )


@query(
    "x_offer_languages",
    """
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'en' THEN source ELSE '' END AS title,
       CASE WHEN lang = 'en' THEN md5(text) ELSE md5('') END AS description_hash,
       CASE WHEN lang = 'en' THEN CAST(length(line) AS BIGINT) ELSE 0 END AS plan_title_length,
       CASE WHEN lang = 'en' THEN md5(line) ELSE md5('') END AS plan_title_hash, CASE WHEN lang = 'en' AND n_chars > 2000 THEN 1 ELSE 0 END AS is_externally_billed
FROM (SELECT doc_id, lang, source, text, n_chars, unnest(CASE WHEN lang = 'en' THEN string_split(text, chr(10)) ELSE [''] END) AS line FROM documents)""",
)
def x_offer_languages(t: Tables):
    none = F.lit(None).cast("string")
    plan = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            none.alias("NaturalIdentifier"), line.alias("Title"), none.alias("Summary"), none.alias("Description"),
            (F.col("n_chars") > 2000).alias("RequiresExternalLicense"),
        ),
    )
    language = F.struct(
        F.col("source").alias("Title"), none.alias("Summary"), F.col("text").alias("Description"),
        plan.alias("ServicePlanDescriptions"),
    )
    documents = t.documents.select(
        _text("doc_id").alias("Id"), _text("doc_id").alias("PublisherId"), none.alias("PublisherNaturalIdentifier"),
        none.alias("NaturalIdentifier"), none.alias("Version"), F.create_map("lang", language).alias("Languages"),
    )
    rows = offers.offer_languages(documents, "en")
    return rows.select(
        F.col("Id").alias("id"), F.col("Title").alias("title"), F.md5("Description").alias("description_hash"),
        F.length("SP_Title").cast("bigint").alias("plan_title_length"), F.md5("SP_Title").alias("plan_title_hash"),
        F.col("IsExternallyBilled").alias("is_externally_billed"),
    )


BRAND_NAMES = {"Brand#1": "First", "Brand#2": "Second"}


def offer_sources(t: Tables):
    brand, kind = F.col("p_brand"), F.col("p_type")
    named = text.override_id(brand, BRAND_NAMES, F.lower(brand))
    offer_type = F.when(kind == "SMALL", offers.APP_SERVICE).when(kind == "LARGE", offers.VIRTUAL_MACHINE).otherwise(
        offers.DATA_SERVICE
    )
    ids = [brand.alias("publisher_id"), F.lower(brand).alias("publisher_nid"), F.col("p_name").alias("offer")]
    version = day_text("l_shipdate").alias("version")
    rows = t.part.select(
        "p_partkey", *ids, _text("p_partkey").alias("offer_id"), offer_type.alias("offer_type"), kind.alias("plan"),
        F.when(F.col("p_size") > 25, " true").otherwise("no").alias("is_preview"),
    ).join(t.lineitem, F.col("l_partkey") == F.col("p_partkey"))
    id_names = ["publisher_id", "publisher_nid", "offer"]
    part_ids = [named.alias("publisher"), F.col("p_name").alias("offer"), kind.alias("plan")]
    number = _text("p_partkey")
    newest_first = F.lpad(number, 18, "0").alias("version")
    coded = F.concat(F.lit("P"), number)
    none = F.lit(None).cast("string")
    return offers.OfferSources(
        offers=rows.select(
            "offer_id", *id_names, "offer_type", version,
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("created_text"), "is_preview",
        ),
        plans=rows.select(
            *id_names, "plan", version,
            F.when(F.col("l_returnflag") == "R", offers.METERED_EFFECT).otherwise("Other").alias("effect"),
        ),
        # Parts outside of a size carry no offer, so lookups miss.
        details=t.part.select(
            named.alias("publisher_nid"), F.when(F.col("p_size") > 10, F.col("p_name")).alias("offer"), kind.alias("plan"), newest_first,
            F.concat(F.lit("T"), number).alias("title"), none.alias("description"), none.alias("plan_title"),
            none.alias("plan_summary"), none.alias("plan_description"), F.lit(0).alias("externally_billed"),
            (F.col("p_size") > 25).alias("needs_licence"),
        ),
        images=t.part.select(
            *_of_size(part_ids, F.col("p_size") < 30), newest_first, F.concat(F.lit("OS"), _text("p_size")).alias("os_name"), kind.alias("os_family")
        ),
        baseline_ids=t.part.select(
            *_of_size(part_ids, F.col("p_size") > 40), coded.alias("plan_id"), coded.alias("image_repository_id")
        ),
        plan_overrides=t.part.where((kind == "ECONOMY") & F.col("p_name").like("red%")).select(
            F.col("p_name").alias("offer"), kind.alias("plan_override"), F.lit("budget").alias("plan")
        ),
        offer_overrides=t.part.where((brand == "Brand#1") & F.col("p_name").like("blue%")).select(
            named.alias("publisher"), F.col("p_name").alias("offer_override"),
            F.concat(F.lit("prime "), "p_name").alias("offer"),
        ),
        multi_solutions=t.part.select(
            F.lit("template").alias("template_uri"), F.col("p_name").alias("offer"), F.lit("v1").alias("version"),
            F.concat(F.lit("All of "), "p_name").alias("title"), none.alias("description"),
            F.lower(brand).alias("publisher"),
            F.when(kind == "PROMO", "a,multiResourceSolution").otherwise("other").alias("categories"),
        ),
    )


BUILT = [
    "publisher", "offer", "plan", "offer_type", "version_published", "created_text", "is_preview", "metered_version",
    "title", "needs_licence", "os_name", "plan_id", "plan_name_override", "offer_name_override", "is_usage_billed",
    "is_multi_solution", "row_key",
]


@query(
    "x_dimension_build",
    """
WITH rows AS (
  SELECT CASE p_brand WHEN 'Brand#1' THEN 'First' WHEN 'Brand#2' THEN 'Second' ELSE lower(p_brand) END AS publisher, p_name AS offer, p_type AS plan,
         l_shipdate, l_returnflag, l_partkey, p_partkey, p_size,
         CASE p_type WHEN 'SMALL' THEN 'AppService' WHEN 'LARGE' THEN 'VirtualMachine' ELSE 'DataService' END AS kind
  FROM lineitem JOIN part ON l_partkey = p_partkey
), current AS (
  SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY publisher, offer ORDER BY l_shipdate DESC, CAST(p_partkey AS VARCHAR)) = 1
), plans AS (SELECT DISTINCT publisher, offer, plan FROM rows),
metered AS (SELECT publisher, offer, plan, strftime(max(l_shipdate), '%Y-%m-%d') AS metered_version FROM rows WHERE l_returnflag = 'R' GROUP BY ALL),
parts AS (SELECT CASE p_brand WHEN 'Brand#1' THEN 'First' WHEN 'Brand#2' THEN 'Second' ELSE lower(p_brand) END AS publisher, * FROM part),
details AS (SELECT * FROM parts WHERE p_size > 10 QUALIFY row_number() OVER (PARTITION BY publisher, p_name, p_type ORDER BY p_partkey DESC) = 1),
images AS (SELECT * FROM parts WHERE p_size < 30 QUALIFY row_number() OVER (PARTITION BY publisher, p_name, p_type ORDER BY p_partkey DESC) = 1),
base AS (SELECT publisher, p_name, p_type, min('P' || p_partkey) AS plan_id, min('P' || p_partkey) AS image_repository_id FROM parts WHERE p_size > 40 GROUP BY 1, 2, 3),
solutions AS (SELECT DISTINCT lower(p_brand) AS publisher, p_name AS offer FROM part WHERE p_type = 'PROMO')
SELECT c.publisher, c.offer, p.plan, CASE WHEN c.kind = 'AppService' AND p.plan IS NOT NULL THEN 'AppService B+C' WHEN c.kind = 'VirtualMachine' THEN 'VirtualMachineService' ELSE c.kind END AS offer_type,
  strftime(c.l_shipdate, '%Y-%m-%d') AS version_published, strftime(c.l_shipdate, '%Y-%m-%d %H:%M:%S') || '.000' AS created_text,
  CASE WHEN c.p_size > 25 THEN 1 ELSE 0 END AS is_preview, m.metered_version, 'T' || d.p_partkey AS title, CASE WHEN d.p_size > 25 THEN 1 ELSE 0 END AS needs_licence,
  'OS' || i.p_size AS os_name, b.plan_id, CASE WHEN p.plan = 'ECONOMY' AND c.offer LIKE 'red%' THEN 'budget' END AS plan_name_override,
  CASE WHEN c.publisher = 'First' AND c.offer LIKE 'blue%' THEN 'prime ' || c.offer END AS offer_name_override,
  CASE WHEN c.kind = 'AppService' AND p.plan IS NOT NULL THEN 1 ELSE 0 END AS is_usage_billed, 0 AS is_multi_solution,
  c.publisher || '_' || c.offer || '_' || coalesce(p.plan, '') AS row_key
FROM current c LEFT JOIN plans p ON c.publisher = p.publisher AND c.offer = p.offer
LEFT JOIN metered m ON c.publisher = m.publisher AND c.offer = m.offer AND p.plan = m.plan
LEFT JOIN details d ON c.publisher = d.publisher AND c.offer = d.p_name AND p.plan = d.p_type
LEFT JOIN images i ON c.publisher = i.publisher AND c.offer = i.p_name AND p.plan = i.p_type
LEFT JOIN base b ON c.publisher = b.publisher AND c.offer = b.p_name AND p.plan = b.p_type
UNION ALL
SELECT publisher, offer, NULL, 'MultiSolution', 'v1', NULL, NULL, NULL, 'All of ' || offer, NULL, NULL, NULL, NULL, NULL, NULL, 1, publisher || '_' || offer || '_'
FROM solutions""",
)
def x_dimension_build(t: Tables):
    return offers.offer_dimension(offer_sources(t), BRAND_NAMES).select(*BUILT)


def _of_size(columns, condition):
    """Publisher, offer and plan, where the offer is null unless the condition holds."""
    publisher, _, plan = columns
    return [publisher, F.when(condition, F.col("p_name")).alias("offer"), plan]


def _plan_of(key: str):
    return F.concat(F.lit("plan"), F.pmod(F.col(key), F.lit(3)).cast("string"))


def buyers(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("parent_id"), F.col("c_mktsegment").alias("publisher"),
        F.concat(F.lit("NATION_"), _text("c_nationkey"), F.lit("-preview")).alias("offer"), _plan_of("c_custkey").alias("plan"),
        F.lit("USD").alias("currency"),
    )


def payers(t: Tables):
    return t.customer.select(
        _text("c_custkey").alias("order_id"), F.lit("Subscription").alias("payer_type"),
        F.concat(F.lit("S"), _text("c_custkey")).alias("payer_value"),
    )


def order_lookups(t: Tables):
    nation = _text("c_nationkey")
    offer = F.concat(F.lit("NATION_"), nation)
    # Poor customers carry no offer, so lookups miss.
    offer_dim = t.customer.select(
        F.when(F.col("c_acctbal") > 6000, offer).alias("offer"), _plan_of("c_custkey").alias("plan"), F.col("c_mktsegment").alias("publisher"),
        F.concat(F.lit("OF"), nation).alias("offer_id"), F.lit(0).alias("is_preview"), F.lit("x").alias("offer_type"),
        F.concat_ws("_", "c_mktsegment", offer, _plan_of("c_custkey")).alias("row_key"),
    )
    offer_key = F.concat(F.lit("OF"), _text("s_nationkey")).alias("offer_id")
    balance = F.col("s_acctbal")
    return orders.OrderLookups(
        publishers=t.customer.where(F.col("c_mktsegment") != "BUILDING").select(F.col("c_mktsegment").alias("publisher")),
        offers=offer_dim,
        overrides=t.customer.where(F.col("c_nationkey") < 5).select(
            F.col("c_mktsegment").alias("publisher"), F.concat(offer, F.lit("-preview")).alias("offer"),
            _plan_of("c_custkey").alias("plan"), F.lit("plan0").alias("plan_override"),
        ),
        onboarding=t.supplier.select(
            offer_key, _plan_of("s_suppkey").alias("plan"), F.when(balance > 3000, "true").otherwise("no").alias("billed_outside"),
            F.col("s_suppkey").alias("created_ts"),
        ),
        languages=t.supplier.select(
            offer_key, _plan_of("s_suppkey").alias("plan"),
            F.when(balance < 1000, True).when(balance < 5000, False).alias("needs_licence"),
            F.col("s_suppkey").alias("version"),
        ),
        market_prices=orders.zero_market_prices(
            t.part.select(
                F.concat(F.lit("OF"), F.pmod("p_partkey", F.lit(25)).cast("string")).alias("offer_id"),
                _plan_of("p_size").alias("plan"), F.col("p_type").alias("effect"),
                F.when(F.pmod("p_partkey", F.lit(25)) < 12, 0.0).otherwise(F.col("p_retailprice")).alias("amount"),
            ),
            trial_effect="PROMO",
        ),
    )


TIMELINE_SQL = """
dedup AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('second', ts) ORDER BY ts, event_id) = 1
), seen AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_name
  FROM dedup WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type DESC, event_id)
), windows AS (
  SELECT user_id, min(ts) AS window_start, min(ts) FILTER (WHERE event_type = 'error') AS window_end FROM events GROUP BY user_id
), timeline AS (
  SELECT event_id AS entry_id, user_id, event_type AS name, value AS price,
    CASE WHEN coalesce(window_end = next_ts, false) THEN 'Cancelled' WHEN next_name IS NULL THEN 'Active' ELSE next_name END AS end_name,
    CASE next_name WHEN 'purchase' THEN 'Promotion' WHEN 'click' THEN 'Trial' ELSE 'None' END AS discount,
    CASE WHEN strftime(ts, '%H:%M:%S') = '23:59:59' THEN ts + INTERVAL 1 SECOND
         WHEN ts = prev_ts OR ts = prev_ts + INTERVAL 1 SECOND THEN ts + INTERVAL 2 SECOND ELSE ts END AS start_ts,
    CASE WHEN next_ts IS NULL THEN window_end WHEN strftime(next_ts, '%H:%M:%S') = '23:59:59' THEN next_ts
         WHEN next_ts = ts THEN ts + INTERVAL 1 SECOND WHEN next_ts = ts + INTERVAL 1 SECOND THEN next_ts + INTERVAL 1 SECOND
         ELSE next_ts - INTERVAL 1 SECOND END AS end_ts
  FROM seen JOIN windows USING (user_id)
  WHERE event_type <> 'error' AND (next_ts IS NULL OR window_end IS NULL OR next_ts <= window_end)
    AND (window_end IS NULL OR ts < window_end OR window_start = window_end)
    AND NOT (ts = window_start AND (event_type = 'view' OR coalesce(next_name = 'signup', false)))
)"""


@query(
    "x_order_dimension",
    f"""
WITH {TIMELINE_SQL}, headers AS (
  SELECT user_id, min(start_ts) AS purchase, max(coalesce(end_ts, TIMESTAMP '9999-01-01')) AS cancel FROM timeline GROUP BY user_id
), offer_dim AS (
  SELECT DISTINCT 'NATION_' || c_nationkey AS offer, 'plan' || (c_custkey % 3) AS plan, c_mktsegment AS publisher, 'OF' || c_nationkey AS offer_id,
         c_mktsegment || '_NATION_' || c_nationkey || '_plan' || (c_custkey % 3) AS row_key FROM customer WHERE c_acctbal > 6000
), loose AS (SELECT offer, plan, min(row_key) AS row_key, min(offer_id) AS offer_id FROM offer_dim GROUP BY 1, 2),
onboarding AS (SELECT 'OF' || s_nationkey AS offer_id, 'plan' || (s_suppkey % 3) AS plan, s_acctbal > 3000 AS outside FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 3 ORDER BY s_suppkey DESC) = 1),
languages AS (SELECT 'OF' || s_nationkey AS offer_id, 'plan' || (s_suppkey % 3) AS plan, CASE WHEN s_acctbal < 1000 THEN TRUE WHEN s_acctbal < 5000 THEN FALSE END AS lic FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 3 ORDER BY s_suppkey DESC) = 1),
discounts AS (SELECT user_id, discount, end_ts FROM timeline WHERE discount <> 'None'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY end_name DESC, coalesce(end_ts, TIMESTAMP '9999-01-01') DESC, entry_id DESC) = 1),
latest AS (SELECT user_id, end_name, price FROM timeline QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start_ts DESC) = 1),
facts AS (
  SELECT h.*, c_mktsegment AS publisher, 'NATION_' || c_nationkey AS offer_cut, 'plan' || (h.user_id % 3) AS plan, c_nationkey,
         x.row_key AS x_key, coalesce(x.offer_id, l.offer_id) AS offer_id, coalesce(x.offer, l.offer) AS found_offer
  FROM headers h JOIN customer ON h.user_id = c_custkey
  LEFT JOIN offer_dim x ON x.offer = 'NATION_' || c_nationkey AND x.plan = 'plan' || (h.user_id % 3) AND x.publisher = c_mktsegment AND c_mktsegment <> 'BUILDING'
  LEFT JOIN loose l ON x.offer IS NULL AND l.offer = 'NATION_' || c_nationkey AND l.plan = 'plan' || (h.user_id % 3)
  WHERE c_mktsegment <> 'FURNITURE'
), keyed AS (SELECT *, CASE WHEN c_nationkey < 5 THEN 'plan0' ELSE plan END AS plan_key FROM facts)
SELECT CAST(k.user_id AS VARCHAR) AS order_id, 'S' || k.user_id AS subscription_id, publisher AS publisher_name,
  coalesce(found_offer, offer_cut || '-preview') AS offer_name, k.plan AS plan_name, x_key AS offer_row_key,
  epoch_us(purchase) // 1000 AS purchase_ms, CASE WHEN cancel < TIMESTAMP '9999-01-01' THEN epoch_us(cancel) // 1000 ELSE -1 END AS cancel_ms,
  t.end_name AS current_status, CASE WHEN d.discount = 'Trial' THEN 1 ELSE 0 END AS is_trial,
  CASE WHEN g.lic OR (g.lic IS NULL AND coalesce(o.outside, FALSE)) THEN 'Free' WHEN t.price = 0 THEN 'Free' WHEN t.price > 0 THEN 'Paid' ELSE 'Unknown' END AS billing_type,
  CASE WHEN g.lic IS NULL AND coalesce(o.outside, FALSE) THEN 'BYOL' WHEN g.lic THEN 'Unknown' ELSE 'Billed' END AS payment_type
FROM keyed k LEFT JOIN onboarding o ON k.offer_id = o.offer_id AND k.plan_key = o.plan LEFT JOIN languages g ON k.offer_id = g.offer_id AND k.plan_key = g.plan
LEFT JOIN discounts d ON k.user_id = d.user_id LEFT JOIN latest t ON k.user_id = t.user_id""",
)
def x_order_dimension(t: Tables):
    timeline = orders.price_timeline(frames.history(t), names=frames.EVENT_NAMES).join(buyers(t), "parent_id")
    timeline = stage(orders.with_subscription(timeline, payers(t), "Subscription"), "timeline")
    headers = orders.order_headers(timeline)
    lookups = order_lookups(t)
    dim = orders.order_dimension(headers, timeline, lookups, excluded_publisher="FURNITURE")
    return dim.select(
        "order_id", "subscription_id", "publisher_name", "offer_name", "plan_name", "offer_row_key",
        times.millis(F.col("purchase_ts")).alias("purchase_ms"),
        F.coalesce(times.millis(F.col("cancel_ts")), F.lit(-1)).alias("cancel_ms"),
        "current_status", "is_trial", "billing_type", "payment_type",
    )


@query(
    "x_publisher_dimension",
    """
WITH current AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority, o_orderstatus) = 1)
SELECT CAST(c_custkey AS VARCHAR) AS publisher_id, c_name AS publisher, coalesce(o_orderpriority, 'N' || c_nationkey) AS legal_name, o_orderstatus AS short_name,
  CASE WHEN s_acctbal > 2000 THEN s_name ELSE 'N' || c_nationkey END AS owner_email, CASE WHEN s_acctbal > 2000 THEN n_name END AS country_code,
  CASE WHEN c_acctbal < 0 THEN 1 WHEN contains(lower(coalesce(o_orderpriority, '')), 'urgent') OR contains(lower(CASE WHEN s_acctbal > 2000 THEN s_name ELSE 'N' || c_nationkey END), '0000007') THEN 1 ELSE 0 END AS is_internal,
  c_custkey || ':' || c_name AS publisher_key
FROM customer JOIN current ON c_custkey = o_custkey LEFT JOIN supplier ON c_custkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def x_publisher_dimension(t: Tables):
    key = _text("c_custkey")
    none = F.lit(None).cast("string")
    listed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("publisher_id"), F.col("c_name").alias("publisher_nid"), F.col("o_orderpriority").alias("legal_name"),
        F.col("o_orderstatus").alias("short_name"), F.col("o_orderdate").alias("listed_ts"),
    )
    fallback = F.concat(F.lit("N"), _text("c_nationkey"))
    onboarding = t.customer.select(
        key.alias("publisher_id"), fallback.alias("legal_name"), none.alias("short_name"), fallback.alias("owner_email"),
        *[none.alias(c) for c in ("owner_id", "region_code", "created", "approved", "tax_profile_id", "payout_account_id")],
    )
    seller = _text("s_suppkey")
    contacts = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    reached = F.when(F.col("s_acctbal") > 2000, seller)
    sources = publishers.PublisherSources(
        listed=listed, onboarding=onboarding,
        portal=t.customer.select(
            key.alias("publisher_id"), key.alias("puid"), none.alias("payout_account_id"), none.alias("tax_profile_id")
        ),
        accounts=t.supplier.select(seller.alias("puid"), seller.alias("seller_id")),
        commercial=t.supplier.select(seller.alias("seller_id"), none.alias("bank_id"), none.alias("universal_account_id")),
        contacts=contacts.select(reached.alias("seller_id"), F.col("s_name").alias("email"), F.col("n_name").alias("country_code")),
        internal=t.customer.where(F.col("c_acctbal") < 0).select(key.alias("publisher_id"), F.lit(1).alias("is_internal")),
        name_overrides=t.nation.select(F.col("n_name").alias("override_value"), F.col("n_name").alias("publisher_nid")),
    )
    dim = publishers.publisher_dimension(sources, company_word="urgent", company_domain="0000007")
    return dim.select(
        "publisher_id", "publisher", "legal_name", "short_name", "owner_email", "country_code", "is_internal", "publisher_key"
    )


@query(
    "x_enrollment_dimension",
    """
SELECT o_orderkey AS enrollment_id, n_name AS status, r_name AS region, coalesce(p_name, '') AS program, coalesce(p_size, -99999) AS program_size,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Direct Enterprise' WHEN '2-HIGH' THEN 'Indirect Enterprise' ELSE '' END AS channel,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000' END AS starts, CAST(o_orderkey AS VARCHAR) AS row_key
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON o_orderkey = p_partkey
WHERE n_nationkey < 20 AND o_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
)
def x_enrollment_dimension(t: Tables):
    priority = F.col("o_orderpriority")
    channel = F.when(priority == "1-URGENT", "EaDirect").when(priority == "2-HIGH", "MpsaIndirect").otherwise(priority)
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.part.select("p_partkey", F.col("p_size").alias("program_size")), F.col("o_orderkey") == F.col("p_partkey"), "left")
    )
    ids = {c: F.col("n_nationkey") for c, _ in enrollment.LOOKUPS.values()}
    ids |= {"region_id": F.col("n_regionkey"), "program_id": F.col("o_orderkey")}
    base = rows.select(
        F.col("o_orderkey").alias("enrollment_id"), channel.alias("channel"), "program_size",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("starts"), *[e.alias(c) for c, e in ids.items()],
    )
    nation = F.col("n_nationkey")
    code = t.nation.select(
        nation.alias("id"), F.col("n_name").alias("name"), F.col("n_name").alias("code"),
        F.col("n_name").alias("external_code"),
        F.when(nation < 20, "Enrollment").otherwise("Other").alias("related_type"),
    )
    lookups = {name: code for name in enrollment.LOOKUPS}
    lookups["auth_status"] = code.withColumn("related_type", F.lit("AuthLevel"))
    lookups["regions"] = t.region.select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), F.col("r_name").alias("code")
    )
    lookups["programs"] = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("code")
    )
    account = F.col("o_custkey").alias("account_id")
    chain = enrollment.SubscriptionChain(
        enrollment_account=t.orders.select(account, F.col("o_orderkey").alias("enrollment_id")),
        account_subscription=t.orders.select(account, F.col("o_custkey").alias("subscription_key")),
        subscriptions=t.customer.select(
            F.col("c_custkey").alias("account_id"), F.col("c_custkey").alias("subscription_key"),
            F.concat(F.lit("SUB"), _text("c_custkey")).alias("subscription_id"),
        ),
        staged=t.events.where(F.col("event_type") == "signup").select(
            F.concat(F.lit("sub"), _text("user_id")).alias("subscription_id")
        ),
    )
    dim = enrollment.enrollment_dimension(base, lookups, chain, ["starts"])
    return dim.select("enrollment_id", "status", "region", "program", "program_size", "channel", "starts", "row_key")


@query(
    "x_licence_types",
    """
WITH validity AS (
  SELECT o_custkey AS sub, min(o_orderdate) FILTER (o_orderstatus = 'F') AS f_start, max(o_orderdate) FILTER (o_orderstatus = 'F') AS f_end,
         max(o_orderdate) FILTER (o_orderpriority = '5-LOW') AS l_end FROM orders GROUP BY 1
)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN c_custkey IS NULL THEN 'PAYG'
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND inside THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'Direct Enterprise' ELSE 'Indirect Enterprise' END
       WHEN o_orderstatus = 'O' THEN 'Direct Enterprise' ELSE 'PAYG' END AS licence_type
FROM (SELECT *, (f_start IS NULL OR o_orderdate >= f_start) AND (f_end IS NULL OR o_orderdate <= f_end) AND (l_end IS NULL OR o_orderdate <= l_end) AS inside
      FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey LEFT JOIN validity ON o_custkey = sub)""",
)
def x_licence_types(t: Tables):
    key, customer = _text("o_orderkey"), F.col("o_custkey")
    status, day = F.col("o_orderstatus"), F.to_date("o_orderdate")
    dim = t.orders.select(
        key.alias("order_id"), F.concat(F.lit("S"), customer.cast("string")).alias("subscription_id"),
        F.col("o_orderdate").alias("purchase_ts"),
    )
    billing = t.orders.where(status == "O").select(
        key.alias("order_id"), F.lit("EA").alias("billing_system"), F.col("o_orderdate").alias("ts")
    )
    # Customers in debt carry no subscription id, so lookups miss.
    subscriptions = t.customer.select(
        F.col("c_custkey").alias("subscription_key"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("S"), _text("c_custkey"))).alias("subscription_id"),
    )
    spans = t.orders.groupBy(customer.alias("account_id")).agg(
        F.min(F.when(status == "F", day)).alias("starts"), F.max(F.when(status == "F", day)).alias("ends"),
        F.max(F.when(F.col("o_orderpriority") == "5-LOW", day)).alias("low_end"),
    )
    open_day = F.lit(None).cast("date")
    channels = orders.subscription_channels(
        spans.select("account_id", F.col("account_id").alias("subscription_key"), "starts", open_day.alias("ends")),
        spans.select("account_id", F.col("account_id").alias("enrollment_id"), open_day.alias("starts"), "ends"),
        subscriptions,
        t.customer.join(spans, F.col("c_custkey") == F.col("account_id")).select(
            F.col("c_custkey").alias("enrollment_id"),
            orders.states.channel_name(F.col("c_mktsegment"), ["BUILDING"], ["MACHINERY"]).alias("channel"),
            open_day.alias("starts"), F.col("low_end").alias("ends"), open_day.alias("amendment_starts"),
            open_day.alias("amendment_ends"),
        ),
    )
    return orders.licence_types(dim, billing, subscriptions, channels, "EA").select("order_id", "licence_type")


@query(
    "x_subscription_dimension",
    """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def x_subscription_dimension(t: Tables):
    ordered = t.orders.where(F.col("o_orderstatus") == "P").select(
        F.concat(F.lit("SUB-"), _text("o_custkey")).alias("subscription_id")
    )
    snapshot = t.customer.select(
        F.concat(F.lit("sub-"), _text("c_custkey")).alias("subscription_id"), "c_custkey", "c_name"
    )
    return orders.referenced_subscriptions(ordered, snapshot).select("c_custkey", "c_name")
