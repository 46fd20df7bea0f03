"""Offer documents, service plans, images and the offer dimension.

Offer documents hold dictionaries (one entry per country or plan). They are read as maps, so
that one explode serves any number of countries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import nested, text, times
from stallbook.operators.projections import row_key, with_constants, with_wanted_columns
from stallbook.operators.sets import checked_union
from stallbook.operators.windows import Sort, newest

# Offer types, effects and formats.
VIRTUAL_MACHINE, DATA_SERVICE, APP_SERVICE = "VirtualMachine", "DataService", "AppService"
APP_SERVICE_BILLED, VIRTUAL_MACHINE_SERVICE = "AppService B+C", "VirtualMachineService"
MULTI_SOLUTION = "MultiSolution"
METERED_EFFECT = "UsageChargeForMeteredResource"
MULTI_SOLUTION_CATEGORY = "multiResourceSolution"
OFFER_TIME = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}.[0-9]{2}.[0-9]{2}.[0-9]{3}"

_TEXT = "string"
PRICE_ENTRY = "struct<Amount:double,AppliesTo:string,Effect:string>"
MARKET_PLAN = f"struct<CurrencyCode:string,NaturalIdentifier:string,PricePlan:array<{PRICE_ENTRY}>>"
IMAGE = "struct<OperatingSystem:string,OperatingSystemFamily:string,Version:string>"
PLAN_TEXT = (
    "struct<NaturalIdentifier:string,Title:string,Summary:string,Description:string,"
    "RequiresExternalLicense:boolean>"
)
LANGUAGE = f"struct<Title:string,Summary:string,Description:string,ServicePlanDescriptions:array<{PLAN_TEXT}>>"
OFFER = (
    "struct<Id:string,PublisherId:string,PublisherNaturalIdentifier:string,NaturalIdentifier:string,"
    "Version:string,Timestamp:string,IsPreview:string,DataServiceId:string,FulfillmentServiceId:string,"
    f"Languages:map<string,{LANGUAGE}>,"
    f"ServicePlansByMarket:map<string,array<{MARKET_PLAN}>>,"
    f"VirtualMachineImagesByServicePlan:map<string,array<{IMAGE}>>>"
)
DOCUMENT_SCHEMA = f"offers array<{OFFER}>"


def offer_type(images: Column, data_service: Column, fulfilment: Column) -> Column:
    """Kind of an offer by the first of three properties that is present."""
    return (
        F.when(images.isNotNull(), VIRTUAL_MACHINE)
        .when(data_service.isNotNull(), DATA_SERVICE)
        .when(fulfilment.isNotNull(), APP_SERVICE)
    )


def mapped_offer_type(kind: Column, plan: Column) -> Column:
    return (
        F.when((kind == APP_SERVICE) & plan.isNotNull(), APP_SERVICE_BILLED)
        .when(kind == VIRTUAL_MACHINE, VIRTUAL_MACHINE_SERVICE)
        .otherwise(kind)
    )


def is_usage_billed(kind: Column, plan: Column) -> Column:
    return F.coalesce(((kind == APP_SERVICE) & plan.isNotNull()).cast("int"), F.lit(0))


OFFER_COLUMNS = [
    "Id", "PublisherId", "PublisherNaturalIdentifier", "NaturalIdentifier", "Version", "Timestamp", "IsPreview",
]


def latest_offers(offers: DataFrame, columns: list[str] = OFFER_COLUMNS) -> DataFrame:
    """One flat row per offer with its kind; columns a source lacks become null."""
    kind = offer_type(
        _present(offers, "VirtualMachineImagesByServicePlan"), _present(offers, "DataServiceId"),
        _present(offers, "FulfillmentServiceId"),
    )
    return with_wanted_columns(offers.withColumn("OfferType", kind), [*columns, "OfferType"])


def _present(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(_TEXT)


OFFER_IDS = ["Id", "PublisherId", "PublisherNaturalIdentifier", "NaturalIdentifier", "Version"]


def offer_languages(offers: DataFrame, language: str = "en-US") -> DataFrame:
    """One row per offer and plan description; absent texts are empty."""
    chosen = offers.select(*OFFER_IDS, F.element_at("Languages", language).alias("lang"))
    plans = chosen.select(
        *OFFER_IDS, "lang.Title", "lang.Summary", "lang.Description",
        F.explode_outer("lang.ServicePlanDescriptions").alias("plan"),
    )
    empty = F.lit("")
    return plans.select(
        *OFFER_IDS,
        *[F.coalesce(c, empty).alias(c) for c in ("Title", "Summary", "Description")],
        F.coalesce("plan.NaturalIdentifier", empty).alias("SP_ServicePlanNID"),
        F.coalesce("plan.Title", empty).alias("SP_Title"),
        F.coalesce("plan.Summary", empty).alias("SP_Summary"),
        F.coalesce("plan.Description", empty).alias("SP_Description"),
        F.col("plan.RequiresExternalLicense").alias("SP_RequiresExtLicense"),
        F.coalesce(F.col("plan.RequiresExternalLicense").cast("int"), F.lit(0)).alias("IsExternallyBilled"),
    )


def market_prices(offers: DataFrame) -> DataFrame:
    """One row per country, service plan and price entry."""
    return price_entries(offers, OFFER_IDS, "ServicePlansByMarket", {
        "ServicePlanNID": "NaturalIdentifier", "CurrencyCode": "CurrencyCode",
    }, "PricePlan", {"PP_Amount": "Amount", "PP_AppliesTo": "AppliesTo", "PP_Effect": "Effect"})


def price_entries(
    df: DataFrame, ids: list[str], dictionary: str, plan_fields: dict[str, str], prices: str,
    price_fields: dict[str, str], key: str = "Country",
) -> DataFrame:
    """Dictionary of plans, each with a list of prices, to one row per price."""
    plans = nested.entries_of(df.select(*ids, dictionary), dictionary, key, "plans")
    each = plans.select(*ids, key, F.explode("plans").alias("plan"))
    rows = each.select(
        *ids, key, *[F.col(f"plan.{f}").alias(o) for o, f in plan_fields.items()],
        F.explode(f"plan.{prices}").alias("price"),
    )
    return nested.spread(rows, "price", price_fields)


def images(offers: DataFrame, ids: list[str] = OFFER_IDS[:-1]) -> DataFrame:
    """One row per service plan and machine image, with the image's version."""
    plans = nested.entries_of(
        offers.select(*ids, "VirtualMachineImagesByServicePlan"), "VirtualMachineImagesByServicePlan",
        "ServicePlanName", "images",
    )
    return plans.select(*ids, "ServicePlanName", F.explode("images").alias("image")).select(
        *ids, "ServicePlanName", "image.*"
    )


@dataclass(frozen=True)
class OfferSources:
    """Frames of the offer dimension, in snake-case columns.

    * offers: offer_id, publisher_id, publisher_nid, offer, offer_type, version, created_text, is_preview
    * plans: publisher_id, publisher_nid, offer, plan, version, effect
    * details: publisher_nid, offer, plan, version, title, description, plan_title, plan_summary,
      plan_description, externally_billed, needs_licence
    * images: publisher, offer, plan, version, os_name, os_family
    * baseline_ids: publisher, offer, plan, plan_id, image_repository_id
    * plan_overrides: offer, plan_override, plan
    * offer_overrides: publisher, offer_override, offer
    * multi_solutions: template_uri, offer, version, title, description, publisher, categories
    """

    offers: DataFrame
    plans: DataFrame
    details: DataFrame
    images: DataFrame
    baseline_ids: DataFrame
    plan_overrides: DataFrame
    offer_overrides: DataFrame
    multi_solutions: DataFrame


def newest_version(df: DataFrame, keys: list[str]) -> DataFrame:
    """The highest version per key; the smallest row among equal versions."""
    ties = [Sort(c) for c in df.columns if c not in (*keys, "version")]
    return newest(df, keys, [Sort("version", descending=True), *ties])


def offer_dimension(s: OfferSources, publisher_names: dict[str, str]) -> DataFrame:
    """The offer dimension: newest version of everything, remapped types, multi-resource items."""

    def named(df: DataFrame) -> DataFrame:
        name = text.override_id(F.col("publisher_id"), publisher_names, F.col("publisher_nid"))
        return df.withColumn("publisher", name)

    plan_keys = ["publisher", "offer", "plan"]
    plans = named(s.plans)
    is_metered = F.col("effect") == METERED_EFFECT
    plan_rows = plans.groupBy(*plan_keys).agg(F.max(F.when(is_metered, F.col("version"))).alias("metered_version"))
    current = newest_version(named(s.offers).where(F.col("offer").isNotNull()), ["publisher", "offer"])
    current = current.select(
        "publisher", "offer", "offer_id", "offer_type", F.col("version").alias("version_published"),
        times.parse_millis(F.col("created_text"), OFFER_TIME, times.MILLIS_FORMAT).alias("created_millis"),
        text.flag_text(F.col("is_preview")).alias("is_preview"),
    )
    details = newest_version(s.details.withColumnRenamed("publisher_nid", "publisher"), plan_keys).drop("version")
    vm = newest_version(s.images, plan_keys).select(*plan_keys, "os_name", "os_family")
    baseline = newest(s.baseline_ids, plan_keys, [Sort("plan_id")])
    plan_over = newest(s.plan_overrides, ["offer", "plan_override"], [Sort("plan")]).select(
        "offer", F.col("plan_override").alias("plan"), F.col("plan").alias("plan_name_override")
    )
    offer_over = newest(s.offer_overrides, ["publisher", "offer_override"], [Sort("offer")]).select(
        "publisher", F.col("offer_override").alias("offer"), F.col("offer").alias("offer_name_override")
    )
    joined = (
        current.join(plan_rows, ["offer", "publisher"], "left")
        .join(details, plan_keys, "left")
        .join(vm, plan_keys, "left")
        .join(baseline, plan_keys, "left")
        .join(plan_over, ["offer", "plan"], "left")
        .join(offer_over, ["publisher", "offer"], "left")
    )
    kind, plan = F.col("offer_type"), F.col("plan")
    shaped = joined.withColumns(
        {
            "is_usage_billed": is_usage_billed(kind, plan),
            "needs_licence": text.flag_text(F.col("needs_licence").cast("string")),
            "offer_type": mapped_offer_type(kind, plan),
            "created_text": times.format_millis(F.col("created_millis")),
        }
    ).drop("created_millis")
    shaped = with_constants(shaped, {"data_source": "PubPortal", "is_multi_solution": 0, "template_uri": ""})
    solutions = multi_solution_rows(s.multi_solutions, shaped)
    return checked_union(shaped, solutions).withColumn("row_key", row_key("publisher", "offer", "plan"))


def multi_solution_rows(solutions: DataFrame, like: DataFrame) -> DataFrame:
    """Multi-resource solutions in the shape of the dimension; what they lack is null."""
    chosen = solutions.where(F.col("categories").like(f"%{MULTI_SOLUTION_CATEGORY}%")).select(
        "template_uri", "offer", F.col("version").alias("version_published"), F.col("title"),
        F.col("description"), "publisher", F.lit(MULTI_SOLUTION).alias("offer_type"),
        F.lit("MultiSolution JSON").alias("data_source"), F.lit(1).alias("is_multi_solution"),
    ).distinct()
    return chosen.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in chosen.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )
