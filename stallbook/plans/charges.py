"""The charges fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import text
from stallbook.operators.joins import asof_lookup
from stallbook.operators.merge import merge_changes
from stallbook.operators.windows import Sort, newest

# Known bad charges, the key prefix and the home currency.
BAD_CHARGES = ("56538D9B-ADAB-43AD-A77A-4909B8B05C28", "ABFE232D-2D6E-45D9-87FB-D292170DF500")
KEY_PREFIX = "MONITORING-"
HOME_CURRENCY = "USD"
CHARGES_SOURCE = "ADM"


def day_of(c: Column) -> Column:
    """The date in the first ten characters of a text; null if it is none."""
    return F.substring(c, 1, 10).try_cast("date")


def clean_charges(raw: DataFrame) -> DataFrame:
    """Typed charges from text columns, without the known bad ones."""
    return raw.where(F.coalesce(~F.col("charge_id").isin(*BAD_CHARGES), F.lit(False))).select(
        "charge_id",
        text.strip_prefix(F.col("alternate_order_id"), KEY_PREFIX).alias("order_id"),
        day_of(F.col("submitted")).alias("charged_on"),
        F.col("amount").try_cast("decimal(18,4)").alias("amount"),
        F.col("usage_quantity").try_cast("decimal(18,4)").alias("usage_quantity"),
        day_of(F.col("period_start")).alias("usage_start"),
        day_of(F.col("period_end")).alias("usage_end"),
        "applies_to",
        "region_code",
        "currency",
        "reason_code",
        "is_deferred",
        "defer_reason",
    )


def with_exchange_rate(charges: DataFrame, rates: DataFrame) -> DataFrame:
    """Add ``fx_rate``: the inverse of the latest rate on or before the charge day, else 1.

    rates: rate_currency, rate_day, rate, pulled
    """
    found = asof_lookup(
        charges, rates, [("currency", "rate_currency")], "charged_on", "rate_day", "rate", ["pulled"], "__found"
    )
    inverse = F.try_divide(F.lit(1.0), F.col("__found"))
    return found.withColumn("fx_rate", F.coalesce(inverse, F.lit(1.0))).drop("__found")


def charge_rollup(charges: DataFrame, keys: list[str]) -> DataFrame:
    """Amount, amount in the home currency and usage per keys, currency and rate.

    Amounts are exact while they are summed and become doubles afterwards.
    """
    amount = F.sum("amount").cast("double")
    return (
        charges.groupBy(*keys, "currency", "fx_rate")
        .agg(amount.alias("amount"), F.sum("usage_quantity").alias("usage_quantity"))
        .withColumn(
            "amount_usd",
            F.when(F.col("currency") == HOME_CURRENCY, F.col("amount")).otherwise(F.col("amount") * F.col("fx_rate")),
        )
    )


CHARGE_KEYS = [
    "order_id", "charged_on", "usage_start", "usage_end", "applies_to", "charge_id", "region_code", "reason_code",
    "is_deferred", "defer_reason",
]


def charge_fact(charges: DataFrame, rates: DataFrame, keys: list[str] = CHARGE_KEYS) -> DataFrame:
    """Charges with their rate, rolled up, with the constant columns of the fact."""
    rolled = charge_rollup(with_exchange_rate(charges, rates), keys)
    return rolled.withColumns(
        {"tax_amount": F.lit(0.0), "fx_rate_date": F.col("charged_on"), "data_source": F.lit(CHARGES_SOURCE)}
    )


@dataclass(frozen=True)
class FactKeys:
    keys: tuple[str, ...] = ("charge_id", "applies_to")
    latest: str = "charged_on"


def merge_charges(target: DataFrame, fact: DataFrame, spec: FactKeys = FactKeys()) -> DataFrame:
    """Upsert the fact: update rows that changed, insert new ones, keep the rest.

    The fact may hold several rows of one key, as it is grouped by more columns: the one charged
    last counts, then the highest amount, then the order of the other columns. The target has one
    row per key.
    """
    columns = [c for c in target.columns if c not in spec.keys]
    ties = [Sort(c) for c in columns if c not in (spec.latest, "amount")]
    one = newest(fact, list(spec.keys), [Sort(spec.latest, True), Sort("amount", True), *ties])
    return merge_changes(target, one, list(spec.keys), columns, "action")
