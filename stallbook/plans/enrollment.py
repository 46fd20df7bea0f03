"""The enrolment dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.functions import states, times
from stallbook.operators.joins import star_left
from stallbook.operators.projections import fill_nulls

# Channel codes and status types.
DIRECT_CHANNELS = ["MpsaDirect", "EaDirect"]
INDIRECT_CHANNELS = ["MpsaIndirect", "EaIndirect"]
STATUS_TYPE, AUTH_LEVEL_TYPE = "enrollment", "authlevel"

# Lookup name, column of the enrolment that refers to it, and the columns it contributes.
LOOKUPS = {
    "status": ("status_id", {"name": "status", "external_code": "status_code", "related_type": "status_type"}),
    "auth_status": (
        "auth_level_status_id",
        {"name": "auth_level_status", "external_code": "auth_level_code", "related_type": "auth_level_type"},
    ),
    "operations_centers": ("operations_center_id", {"name": "operations_center", "code": "operations_center_code"}),
    "regions": ("region_id", {"name": "region", "code": "region_code"}),
    "programs": ("program_id", {"name": "program", "code": "program_code"}),
    "agreement_types": ("agreement_type_id", {"name": "agreement_type", "code": "agreement_type_code"}),
    "contract_types": ("contract_type_id", {"name": "contract_type", "code": "contract_type_code"}),
    "licence_types": ("licence_type_id", {"name": "licence_agreement_type", "code": "licence_agreement_code"}),
    "countries": ("country_id", {"name": "country", "code": "country_code"}),
    "currencies": ("currency_id", {"name": "currency", "code": "currency_code"}),
}


@dataclass(frozen=True)
class SubscriptionChain:
    """Frames that tell which enrolments have a subscription in use.

    * enrollment_account: account_id, enrollment_id
    * account_subscription: account_id, subscription_key
    * subscriptions: account_id, subscription_key, subscription_id
    * staged: subscription_id
    """

    enrollment_account: DataFrame
    account_subscription: DataFrame
    subscriptions: DataFrame
    staged: DataFrame


def active_enrollments(chain: SubscriptionChain) -> DataFrame:
    """Ids of enrolments with a staged subscription: semi joins, so nothing fans out."""
    staged = chain.staged.select(F.lower("subscription_id").alias("__id"))
    used = chain.subscriptions.join(staged, F.lower("subscription_id") == F.col("__id"), "left_semi")
    linked = chain.account_subscription.join(used, ["account_id", "subscription_key"], "left_semi")
    return chain.enrollment_account.join(linked, "account_id", "left_semi").select("enrollment_id")


def enrollment_dimension(
    enrollments: DataFrame, lookups: dict[str, DataFrame], chain: SubscriptionChain, date_columns: list[str],
) -> DataFrame:
    """Enrolments in use with their lookups, channel and texts.

    Each lookup has id and the columns LOOKUPS names; dates are times and become text.
    """
    star = []
    for name, (reference, columns) in LOOKUPS.items():
        side = lookups[name].select(F.col("id").alias(f"__{name}"), *[F.col(c).alias(o) for c, o in columns.items()])
        star.append((side, reference, f"__{name}"))
    in_use = enrollments.join(active_enrollments(chain), "enrollment_id", "left_semi")
    wide = star_left(in_use, star).drop(*[f"__{name}" for name in LOOKUPS])
    wide = wide.where((F.lower("auth_level_type") == AUTH_LEVEL_TYPE) & (F.lower("status_type") == STATUS_TYPE))
    wide = wide.withColumn("channel", states.channel_name(F.col("channel"), DIRECT_CHANNELS, INDIRECT_CHANNELS))
    wide = wide.withColumns({f"{c}_long": times.millis(F.col(c)) for c in date_columns})
    filled = fill_nulls(wide, [f"{c}_long" for c in date_columns])
    shown = filled.withColumns({c: times.format_millis(F.col(f"{c}_long")) for c in date_columns})
    return shown.withColumn("row_key", F.col("enrollment_id").cast("string"))
