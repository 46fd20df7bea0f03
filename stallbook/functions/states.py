"""State labels of prices, bills, licences and events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels.
FREE, PAID, UNKNOWN = "Free", "Paid", "Unknown"
MISSING_ORDER, MISSING_PRICE = "OrderAPI Missing Order", "OrderAPI Missing Price"
NO_DISCOUNT, PROMOTION, TRIAL = "None", "Promotion", "Trial"
ACTIVE, CANCELLED = "Active", "Cancelled"
OWN_LICENCE, BILLED = "BYOL", "Billed"
PAY_AS_YOU_GO, DIRECT, INDIRECT = "PAYG", "Direct Enterprise", "Indirect Enterprise"


def priced_state(found: Column, discount: Column, price: Column, otherwise: Column) -> Column:
    """Free or Paid for an undiscounted price, the discount's name for a discounted one."""
    amount = price.cast("decimal(18,4)")
    undiscounted = found & (F.lower(discount) == NO_DISCOUNT.lower())
    return (
        F.when(undiscounted & (amount == 0), FREE)
        .when(undiscounted & (amount > 0), PAID)
        .when(found & discount.isNotNull(), discount)
        .otherwise(otherwise)
    )


def price_state(price_found: Column, discount: Column, price: Column, order_known: Column) -> Column:
    missing = F.when(order_known, MISSING_PRICE).otherwise(MISSING_ORDER)
    return priced_state(price_found, discount, price, missing)


def _billed_inside(needs_licence: Column, billed_outside: Column) -> Column:
    """True unless a licence is needed, or none is known and the offer is billed outside."""
    return ~F.coalesce(needs_licence, billed_outside, F.lit(False))


def billing_type(needs_licence: Column, billed_outside: Column, price: Column, market_price: Column) -> Column:
    """Free, Paid or Unknown, by licence, own price and market price in this order.

    A null ``needs_licence`` is unknown; a null ``billed_outside`` counts as false.
    """
    inside = _billed_inside(needs_licence, billed_outside)
    return (
        F.when(~inside, FREE)
        .when(price == 0, FREE)
        .when(price > 0, PAID)
        .when(market_price == 0, FREE)
        .when(market_price > 0, PAID)
        .otherwise(UNKNOWN)
    )


def payment_type(needs_licence: Column, billed_outside: Column, billed: str = BILLED) -> Column:
    """Own licence when only outside billing is known; Unknown when a licence is needed."""
    return (
        F.when(_billed_inside(needs_licence, billed_outside), billed)
        .when(needs_licence.isNull(), OWN_LICENCE)
        .otherwise(UNKNOWN)
    )


def channel_name(code: Column, direct: list[str], indirect: list[str]) -> Column:
    """Sales channel of an enrolment code; null for any other code."""
    return F.when(code.isin(direct), DIRECT).when(code.isin(indirect), INDIRECT)


def licence_type(subscription: Column, enterprise_billed: Column, channel: Column) -> Column:
    """Licence channel of an order from its subscription and enrolment."""
    enterprise = F.coalesce(enterprise_billed, F.lit(False))
    return (
        F.when(subscription.isNull(), PAY_AS_YOU_GO)
        .when(enterprise & channel.isNull(), DIRECT)
        .when(channel.isNotNull(), channel)
        .otherwise(PAY_AS_YOU_GO)
    )


def event_end_state(next_name: Column, at_cancel: Column) -> Column:
    """State in which an interval ends: cancelled, still active, or the next event's name."""
    return F.when(F.coalesce(at_cancel, F.lit(False)), CANCELLED).when(next_name.isNull(), ACTIVE).otherwise(next_name)


def discount_until(next_name: Column, promotion_end: str, trial_end: str) -> Column:
    """An interval that ends with the end of a promotion or trial was one."""
    name = F.lower(next_name)
    return F.when(name == promotion_end.lower(), PROMOTION).when(name == trial_end.lower(), TRIAL).otherwise(NO_DISCOUNT)
