"""One row per machine from core compute records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import text

# Alias rules (pattern of the mapped publisher, core name) and their publishers,
# and words of billing contexts.
ALIAS_RULES = (
    ("%barracuda%", "barracuda"), ("coreos", "coreos"), ("riverbed steelhead", "riverbed"), ("zulu", "zulu"),
    ("oracle%", "oracle"), ("bitnami", "bitnami"), ("redhat", "redhat"), ("puppet enterprise", "puppet"),
    ("github-enterprise", "github-enterprise"), ("user", "user"),
)
ALIAS_PUBLISHERS = (
    ("barracuda", "barracudanetworks"), ("riverbed", "riverbed"), ("oracle", "msopentech"), ("bitnami", "Bitnami"),
    ("zulu", "azul"), ("coreos", "CoreOS"), ("github-enterprise", "github-enterprise"), ("puppet", "puppet"),
    ("user", "user"), ("redhat", "RedHat"),
)
OS_RULES = (("linux", "Linux"), ("window", "Windows"))
GOVERNMENT_CLOUD, GOVERNMENT_WORD = "usgov", "gov"
USER_IMAGE = "user"
USER_SUFFIX = " USER"


def alias_name(publisher: Column, rules: tuple[tuple[str, str], ...] = ALIAS_RULES) -> Column:
    """Core name of a mapped publisher by the first matching pattern; null if none matches."""
    chain = None
    for pattern, name in rules:
        hit = text.like_any_case(publisher, pattern)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def sku_text(image: Column, sku: Column, billing: Column, image_type: Column) -> Column:
    """Text after the separator of the image name, else the sku, else the billing context."""
    chosen = F.coalesce(text.after_separator(image), text.first_filled(sku), billing, F.lit(""))
    suffix = F.when(F.lower(image_type) == USER_IMAGE, USER_SUFFIX).otherwise("")
    return F.concat(chosen, suffix)


def os_type(billing: Column) -> Column:
    lowered = F.lower(billing)
    chain = None
    for word, name in OS_RULES:
        hit = lowered.contains(word)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def is_government(cloud: Column, location: Column) -> Column:
    return F.coalesce(F.lower(cloud) == GOVERNMENT_CLOUD, F.lit(False)) | text.contains_text(location, GOVERNMENT_WORD)


def entity_summary(
    records: DataFrame, key: str, time: Column, tie: Column, record: list[str], metadata: list[str],
    metadata_order: list[Column], flag: Column, has_metadata: Column | None = None,
) -> DataFrame:
    """Newest record, best metadata row, first time seen and any-flag per entity.

    All four come from one aggregation that is combined before the shuffle, so an entity with
    very many records costs no more than one with few.
    """
    meta = F.struct(*metadata)
    meta = meta if has_metadata is None else F.when(has_metadata, meta)
    rank = F.struct(*metadata_order)
    rank = rank if has_metadata is None else F.when(has_metadata, rank)
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(*record), F.struct(time, tie)).alias("last"),
        F.max_by(meta, rank).alias("meta"),
        F.min(time).alias("first_seen"),
        F.max(flag.cast("int")).alias("any_flag"),
    )


RECORD = [
    "ts", "location", "cloud", "size", "vp_count", "subscription_id", "publisher", "data_source", "quantity_vms",
    "usage_hours",
]
METADATA = ["billing_context", "image_name", "image_type", "crp_offer", "crp_sku", "crp_publisher", "mapped_publisher"]


def machine_profiles(records: DataFrame, record: list[str] = RECORD) -> DataFrame:
    """The staging rows of core usage: one per machine with names and keys.

    records: vm_id, the RECORD and METADATA columns and record_id (a unique tie breaker).
    """
    spark = records.sparkSession
    image = F.col("image_name")
    filled = records.where(F.col("vm_id") != "")
    summary = entity_summary(
        filled, "vm_id", F.col("ts"), F.col("record_id"), record, METADATA,
        [image.isNotNull().alias("has"), image, F.col("record_id")],
        is_government(F.col("cloud"), F.col("location")),
    )
    billing, publisher = F.col("meta.billing_context"), F.col("last.publisher")
    sku = sku_text(F.col("meta.image_name"), F.col("meta.crp_sku"), billing, F.col("meta.image_type"))
    aliases = spark.createDataFrame(list(ALIAS_PUBLISHERS), "alias string, publisher_name string")
    named = summary.withColumn("__alias", alias_name(publisher)).join(
        F.broadcast(aliases), F.col("__alias") == F.col("alias"), "left"
    )

    def spaced(c: Column) -> Column:
        return F.regexp_replace(c, "_", " ")

    dash = F.lit("-")
    return named.select(
        "vm_id", *[F.col(f"last.{c}").alias(c) for c in record],
        billing.alias("billing_context"), F.col("meta.crp_offer").alias("crp_offer"),
        F.col("meta.crp_sku").alias("crp_sku"), F.col("meta.crp_publisher").alias("crp_publisher"),
        "first_seen", F.col("any_flag").alias("has_used_gov_cloud"),
        os_type(billing).alias("os_type"), sku.alias("sku"),
        F.concat(publisher, dash, billing).alias("offer_name"),
        F.concat(publisher, F.lit(":"), billing, F.lit(":"), sku).alias("plan_key"),
        F.concat(publisher, dash, spaced(billing), dash, spaced(sku)).alias("plan_name"),
        F.concat(publisher, dash, spaced(sku)).alias("plan_title"),
        F.concat("vm_id", F.lit(":"), billing).alias("order_key"),
        F.concat(publisher, dash, spaced(billing)).alias("offer_title"),
        is_government(F.col("last.cloud"), F.col("last.location")).cast("int").alias("is_gov"),
        "publisher_name",
    )
