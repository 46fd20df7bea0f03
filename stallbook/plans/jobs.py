"""Jobs end to end: from sources to published, stored results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from stallbook.operators.merge import DimensionSpec
from stallbook.operators.windows import Sort
from stallbook.plans import offers, orders
from stallbook.plans.publish import publish
from stallbook.session import stage
from stallbook.sources.writers import write_snapshot

ORDER_SPEC = DimensionSpec("row_key", (Sort("purchase_ts", True), Sort("order_id")), "data_source", orders.MULTI_ORDER_SOURCE, ("row_key",))
PRICE_SPEC = DimensionSpec("row_key", (Sort("entry_id", True), Sort("meter")), "event_start_name", "", ("row_key",))
OFFER_SPEC = DimensionSpec("row_key", (Sort("version_published", True), Sort("offer_id")), "offer_type", offers.MULTI_SOLUTION, ("row_key",))


@dataclass(frozen=True)
class OrderSources:
    """history, alternates, billing and meters as in ``orders``; payers: order_id, payer_type, payer_value."""

    history: DataFrame
    payers: DataFrame
    lookups: orders.OrderLookups
    last: orders.LastSteps
    alternates: DataFrame | None = None
    billing: DataFrame | None = None
    meters: DataFrame | None = None


@dataclass(frozen=True)
class Published:
    merged: str
    historical: str


@dataclass(frozen=True)
class OrderResult:
    orders: Published
    prices: Published
    subscriptions: str


def order_job(
    s: OrderSources, root: str, slice_id: int, as_of: Column, payer_type: str, names: orders.EventNames = orders.EventNames(),
    excluded_publisher: str | None = None, announced_after: Column | None = None,
) -> OrderResult:
    """One staged timeline feeds two published dimensions, orders and prices, and the hand-off of the orders' subscription ids."""
    timeline = orders.price_timeline(s.history, s.alternates, s.billing, s.meters, names, announced_after)
    timeline = stage(orders.with_subscription(timeline, s.payers, payer_type), "timeline")
    ordinary = orders.order_dimension(orders.order_headers(timeline), timeline, s.lookups, excluded_publisher)
    dimension = stage(orders.complete_dimension(ordinary, timeline, s.last), "order-dimension")
    subscriptions = f"{root}/subscriptions"
    write_snapshot(dimension.select("subscription_id").where("subscription_id IS NOT NULL").distinct(), subscriptions)
    published = [
        Published(*publish(rows, spec, f"{root}/{name}", slice_id, as_of))
        for name, rows, spec in (("orders", dimension, ORDER_SPEC), ("prices", orders.keyed_prices(timeline), PRICE_SPEC))
    ]
    return OrderResult(*published, subscriptions)


def offer_job(s: offers.OfferSources, publisher_names: dict[str, str], root: str, slice_id: int, as_of: Column) -> Published:
    """The offer dimension from its sources to the published slices."""
    return Published(*publish(offers.offer_dimension(s, publisher_names), OFFER_SPEC, f"{root}/offers", slice_id, as_of))
