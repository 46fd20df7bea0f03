"""The publisher dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import text
from stallbook.operators.windows import Sort, newest

# Canonical names of a few publishers and the revenue share.
PUBLISHER_NAMES = {
    "DA8888B8-2418-499B-9C0E-38D328F9A0B2": "ABBYY",
    "059AFC24-07DE-4126-B004-4E42A51816FE": "059afc24-07de-4126-b004-4e42a51816fe",
    "9E4111A6-2681-418E-8FD9-556E6EECEECA": "MelissaData",
    "12DDA869-A9A0-4C6A-82EC-5C8F0F430CFC": "infogroup",
    "10D16C70-F7F7-48A0-8B0C-23BDFB3A291A": "adobe",
}
REVENUE_SPLIT = 0.80


def internal_flag(override: Column, words: dict[str, str]) -> Column:
    """An explicit flag if there is one, else 1 when a column contains its word, else 0.

    ``words`` maps a text column to the word looked for.
    """
    found = F.lit(False)
    for column, word in words.items():
        found = found | text.contains_text(F.col(column), word)
    return F.when(override.isNotNull(), override).otherwise(found.cast("int"))


@dataclass(frozen=True)
class PublisherSources:
    """Frames of the publisher dimension.

    * listed: publisher_id, publisher_nid, legal_name, short_name, listed_ts
    * onboarding: publisher_id, legal_name, short_name, owner_email, owner_id, region_code,
      created, approved, tax_profile_id, payout_account_id
    * portal: publisher_id, puid, payout_account_id, tax_profile_id
    * accounts: puid, seller_id; commercial: seller_id, bank_id, universal_account_id
    * contacts: seller_id, email, country_code
    * internal: publisher_id, is_internal; name_overrides: override_value, publisher_nid
    """

    listed: DataFrame
    onboarding: DataFrame
    portal: DataFrame
    accounts: DataFrame
    commercial: DataFrame
    contacts: DataFrame
    internal: DataFrame
    name_overrides: DataFrame


def publisher_dimension(s: PublisherSources, company_word: str, company_domain: str) -> DataFrame:
    """One row per publisher. Lookups are made one row per key, then left joined."""
    name = text.override_id(F.col("publisher_id"), PUBLISHER_NAMES, F.col("publisher_nid"))
    base = s.listed.where(F.col("publisher_id").isNotNull()).select("publisher_id", name.alias("publisher")).distinct()
    current = newest(s.listed, ["publisher_id"], [Sort("listed_ts", True), Sort("legal_name"), Sort("short_name")]).select(
        "publisher_id", F.col("legal_name").alias("cur_legal"), F.col("short_name").alias("cur_short")
    )
    onboarding = _one(s.onboarding, "publisher_id", "ob_")
    portal = _one(s.portal, "publisher_id", "po_")
    accounts = _one(s.accounts, "puid", "ac_")
    commercial = _one(s.commercial, "seller_id", "cm_")
    contacts = _one(s.contacts, "seller_id", "ct_")
    internal = _one(s.internal, "publisher_id", "in_")
    overrides = _one(s.name_overrides, "override_value", "ov_")
    wide = (
        base.join(current, "publisher_id", "left")
        .join(onboarding, F.col("publisher_id") == F.col("ob_publisher_id"), "left")
        .join(portal, F.col("publisher_id") == F.col("po_publisher_id"), "left")
        .join(accounts, F.col("po_puid") == F.col("ac_puid"), "left")
        .join(commercial, F.col("ac_seller_id") == F.col("cm_seller_id"), "left")
        .join(contacts, F.col("ac_seller_id") == F.col("ct_seller_id"), "left")
        .join(internal, F.col("publisher_id") == F.col("in_publisher_id"), "left")
        .join(overrides, F.col("publisher") == F.col("ov_override_value"), "left")
    )
    named = wide.withColumns(
        {
            "legal_name": F.coalesce("cur_legal", "ob_legal_name"),
            "short_name": F.coalesce("cur_short", "ob_short_name"),
            "owner_email": F.coalesce("ct_email", "ob_owner_email"),
        }
    )
    words = {"publisher": company_word, "legal_name": company_word, "owner_email": company_domain}
    explicit = F.when(F.col("in_publisher_id").isNotNull(), F.col("in_is_internal"))
    return named.select(
        F.concat("publisher_id", F.lit(":"), "publisher").alias("publisher_key"),
        "publisher_id", "publisher", "legal_name", "short_name", "owner_email",
        F.col("ct_country_code").alias("country_code"), F.col("ob_owner_id").alias("owner_id"),
        F.col("ob_region_code").alias("region_code"), F.col("ob_created").alias("created"),
        F.col("ob_approved").alias("approved"), F.col("po_payout_account_id").alias("payout_account_id"),
        F.coalesce("po_tax_profile_id", "ob_tax_profile_id").alias("tax_profile_id"),
        F.coalesce("cm_bank_id", "ob_payout_account_id").alias("bank_id"),
        F.col("cm_universal_account_id").alias("universal_account_id"),
        F.col("ov_publisher_nid").alias("publisher_name_override"),
        F.lit(REVENUE_SPLIT).alias("revenue_split"),
        F.lit("PubPortal").alias("data_source"),
        internal_flag(explicit, words).alias("is_internal"),
        F.col("publisher").alias("row_key"),
    )


def _one(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """One row per key, columns prefixed. Ties go to the smallest row."""
    rest = [Sort(c) for c in df.columns if c != key]
    single = newest(df, [key], rest or [Sort(key)])
    return single.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns})
