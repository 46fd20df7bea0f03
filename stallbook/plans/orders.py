"""Order history, price intervals and the order dimension.

Frames and their columns:

* history: entry_id, parent_id, name, ts, watermark, publisher, offer, plan, price, currency,
  customer_name
* alternate_ids: parent_id, ts, alternate_id
* billing_ids: parent_id, ts, billing_id, billing_system
* meters: meter_id, entry_id, meter, amount
* timeline (result of ``price_timeline``): one row per order, interval and meter
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import states, text, times
from stallbook.operators.aggregates import effective_window, groups_with_zero_sum, sum_of_latest
from stallbook.operators.hot import Ordered, Sort, ranked
from stallbook.operators.joins import intersect_intervals, interval_join, left_where_differs, lookup
from stallbook.operators.projections import row_key
from stallbook.operators.sets import checked_union
from stallbook.operators.windows import first_per_second, newest


@dataclass(frozen=True)
class EventNames:
    """Names of order history events."""

    placed: str = "Placed"
    price_changed: str = "Price Changed"
    cancelled: str = "Canceled"
    trial_ended: str = "Trial Ended"
    promotion_ended: str = "Promotion Discount Ended"
    migrated: str = "External Billing Migrated"


ALTERNATE_ID_LENGTH = 36
MONTHLY = "Monthly"
EVENT_ORDER = [Sort("ts"), Sort("name", descending=True), Sort("entry_id")]


def _is(name: Column, event: str) -> Column:
    return F.lower(name) == event.lower()


def alternate_ids(raw: DataFrame) -> DataFrame:
    """Usable alternate ids: 36 characters or more, cut to the last 36."""
    return raw.where(F.length("alternate_id") >= ALTERNATE_ID_LENGTH).withColumn(
        "alternate_id", text.right_part(F.col("alternate_id"), ALTERNATE_ID_LENGTH)
    )


def identified_history(
    history: DataFrame, alternates: DataFrame | None = None, billing: DataFrame | None = None
) -> DataFrame:
    """One row per event and second with the order id and billing data known at that time."""
    events = first_per_second(history, ["parent_id", "name"], "ts", ["watermark", "entry_id"])
    if alternates is None:
        events = events.withColumn("order_id", F.lit(None).cast("string"))
    else:
        ids = alternates.select("parent_id", "ts", F.col("alternate_id").alias("order_id"))
        events = events.join(ids, ["parent_id", "ts"], "left")
    if billing is None:
        none = F.lit(None).cast("string")
        return events.withColumns({"billing_id": none, "billing_system": none})
    return left_where_differs(
        events, billing.select("parent_id", "ts", "billing_id", "billing_system"), ["parent_id", "ts"],
        "order_id", "billing_id",
    )


def in_event_order(events: DataFrame) -> Ordered:
    return Ordered.of(events, ["parent_id"], EVENT_ORDER)


def filled_down(events: Ordered, names: EventNames = EventNames()) -> Ordered:
    """Events in order with order id and billing data from the previous event, then from the one before.

    Parents with a migration event take them from the previous event only, and are then
    reduced to the newest row per order and billing id.
    """
    filled = ["order_id", "billing_id", "billing_system"]
    far = events.windows(previous={f"p1_{c}": c for c in filled}, before_previous={f"p2_{c}": c for c in filled})

    def fill(rows: DataFrame) -> DataFrame:
        migrated = (
            rows.where(_is(F.col("name"), names.migrated)).select("parent_id").distinct()
            .withColumn("migrated", F.lit(True))
        )
        marked = lookup(rows, migrated, [("parent_id", "parent_id")]).withColumn("migrated", F.coalesce("migrated", F.lit(False)))
        done = marked.withColumns(
            {
                c: F.coalesce(F.col(c), F.col(f"p1_{c}"), F.when(~F.col("migrated"), F.col(f"p2_{c}")))
                for c in filled
            }
        ).drop(*[f"p{n}_{c}" for n in (1, 2) for c in filled])
        moved = newest(
            done.where("migrated"), ["parent_id", "order_id", "billing_id"],
            [Sort("ts", True), Sort("name", True), Sort("entry_id", True)],
        )
        return done.where(~F.col("migrated")).unionByName(moved).drop("migrated")

    return far.replaced(fill)


def fill_down(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """``filled_down`` for events that are not in order yet."""
    return filled_down(in_event_order(events), names).rows()


def price_timeline(
    history: DataFrame,
    alternates: DataFrame | None = None,
    billing: DataFrame | None = None,
    meters: DataFrame | None = None,
    names: EventNames = EventNames(),
    as_of: Column | None = None,
) -> DataFrame:
    """Price intervals per order from its event history. An open end is null.

    ``as_of`` is the time after which an announced trial or promotion end is still to come.
    """
    # Laid out once: the rows that filling down leaves keep their places.
    events = in_event_order(identified_history(history, alternates, billing))
    if alternates is not None or billing is not None:
        events = filled_down(events, names)
    seen = events.windows(
        previous={"prev_ts": "ts", "prev_billing_id": "billing_id", "prev_billing_system": "billing_system"},
        following={"next_ts": "ts", "next_name": "name"},
    ).rows()
    windows = effective_window(history, "parent_id", "name", names.cancelled, "ts").drop("window_state")
    rows = _kept_intervals(lookup(seen, windows, [("parent_id", "parent_id")]), names)
    if meters is not None:
        own = meters.select("entry_id", "meter_id", "meter", "amount")
        rows = rows.join(own, "entry_id", "left")
        price = F.when(F.col("meter").isNull(), F.col("price")).otherwise(F.col("amount"))
    else:
        rows = rows.withColumn("meter", F.lit(None).cast("string"))
        price = F.col("price")
    ts, following = F.col("ts"), F.col("next_ts")
    at_cancel = F.col("window_end") == following
    announced = F.lit(False) if as_of is None else (
        F.lower("next_name").isin(names.trial_ended.lower(), names.promotion_ended.lower()) & (following > as_of)
    )
    end_name = F.when(
        F.coalesce(announced, F.lit(False)) & ~F.coalesce(at_cancel, F.lit(False)), states.ACTIVE
    ).otherwise(states.event_end_state(F.col("next_name"), at_cancel))
    shaped = rows.select(
        "entry_id",
        "parent_id",
        F.coalesce(F.col("order_id"), F.col("parent_id").cast("string")).alias("order_id"),
        F.col("name").alias("event_start_name"),
        end_name.alias("event_end_name"),
        *[c for c in ("publisher", "offer", "plan", "currency", "customer_name") if c in rows.columns],
        price.alias("price"),
        F.coalesce("meter", F.lit(MONTHLY)).alias("meter"),
        states.discount_until(F.col("next_name"), names.promotion_ended, names.trial_ended).alias("discount"),
        times.interval_start(ts, F.col("prev_ts")).alias("start_ts"),
        times.interval_end(ts, following, F.col("window_end")).alias("end_ts"),
        F.coalesce("billing_id", "prev_billing_id").alias("billing_id"),
        F.coalesce("billing_system", "prev_billing_system").alias("billing_system"),
    )
    return shaped


def _kept_intervals(rows: DataFrame, names: EventNames) -> DataFrame:
    ts, name = F.col("ts"), F.col("name")
    first, last, following = F.col("window_start"), F.col("window_end"), F.col("next_ts")
    within = following.isNull() | last.isNull() | (following <= last)
    alive = last.isNull() | (ts < last) | (first == last)
    opening = (ts == first) & (
        _is(name, names.price_changed) | F.coalesce(_is(F.col("next_name"), names.placed), F.lit(False))
    )
    return rows.where(~_is(name, names.cancelled) & within & alive & ~opening)


def keyed_prices(timeline: DataFrame) -> DataFrame:
    """The timeline with its row key ``order_start_end`` in milliseconds, one row per key."""
    keyed = timeline.withColumns(
        {
            "start_ms": times.millis(F.col("start_ts")),
            "end_ms": times.millis(F.coalesce(F.col("end_ts"), times.open_end())),
        }
    ).withColumn("row_key", row_key("order_id", "start_ms", "end_ms"))
    return newest(keyed, ["row_key"], [Sort("entry_id", True), Sort("meter")])


def price_ranks(timeline: DataFrame) -> DataFrame:
    """Recency ranks of intervals: per parent and order, and per order and day. Ties share a rank."""
    rows = timeline.withColumn("start_day", F.date_trunc("day", "start_ts"))
    newest_first = [Sort("start_ts", True)]
    by_order = ranked(rows, ["parent_id", "order_id"], newest_first, "order_price_rank", ties=True)
    return ranked(by_order, ["order_id", "start_day"], newest_first, "order_price_per_day_rank", ties=True)


HEADER_KEYS = [
    "subscription_id", "parent_id", "order_id", "publisher", "offer", "plan", "currency", "billing_id",
    "billing_system",
]


def order_headers(timeline: DataFrame, keys: list[str] = HEADER_KEYS) -> DataFrame:
    """Newest header per order: purchase is its first start, cancel its last end (null = open)."""
    open_end = times.open_end()
    grouped = timeline.groupBy(*keys).agg(
        F.min("start_ts").alias("purchase_ts"),
        F.max(F.coalesce("end_ts", open_end)).alias("cancel_ts"),
    )
    grouped = grouped.withColumn("cancel_ts", F.nullif("cancel_ts", open_end))
    status = timeline.groupBy("order_id").agg(F.min("event_end_name").alias("status"))
    ties = [Sort(k) for k in keys if k != "order_id"]
    return newest(grouped, ["order_id"], [Sort("purchase_ts", True), *ties]).join(status, "order_id", "left")


def with_subscription(timeline: DataFrame, orders: DataFrame, payer_type: str) -> DataFrame:
    """Attach the payer's id of orders whose payer is a subscription.

    orders: order_id, payer_type, payer_value
    """
    payer = orders.select(
        "order_id", F.when(F.col("payer_type") == payer_type, F.col("payer_value")).alias("subscription_id")
    )
    return timeline.join(payer, "order_id", "left")


def last_discount(timeline: DataFrame) -> DataFrame:
    """Last trial or promotion per order: order_id, discount, discount_end."""
    offered = timeline.where(F.col("discount").isin(states.TRIAL, states.PROMOTION))
    open_last = F.coalesce(F.col("end_ts"), times.open_end()).desc()
    return newest(
        offered, ["order_id"], [Sort("event_end_name", True), open_last, Sort("entry_id", True)]
    ).select("order_id", "discount", F.col("end_ts").alias("discount_end"))


def latest_prices(timeline: DataFrame) -> DataFrame:
    """Price of the latest interval per order, end state and currency, summed over meters."""
    amount = F.col("price").cast("decimal(18,4)")
    return sum_of_latest(
        timeline, ["parent_id", "order_id"], "start_ts", ["event_end_name", "currency"], amount, "latest_price"
    ).drop("parent_id")


def zero_market_prices(prices: DataFrame, trial_effect: str = "FreeTrial") -> DataFrame:
    """Offer and plan pairs whose market prices add up to zero, trials aside.

    prices: offer_id, plan, effect, amount
    """
    paid = prices.where(F.col("effect") != trial_effect)
    amount = F.col("amount").cast("decimal(18,4)")
    return groups_with_zero_sum(paid, ["offer_id", "plan"], amount, "market_price")


@dataclass(frozen=True)
class OrderLookups:
    """Frames that enrich orders.

    * publishers: publisher
    * offers: offer, plan, publisher, offer_id, is_preview, offer_type, row_key
    * overrides: publisher, offer, plan, plan_override
    * onboarding: offer_id, plan, billed_outside (text flag), created_ts
    * languages: offer_id, plan, needs_licence (boolean or null), version
    * market_prices: offer_id, plan, market_price
    """

    publishers: DataFrame
    offers: DataFrame
    overrides: DataFrame
    onboarding: DataFrame
    languages: DataFrame
    market_prices: DataFrame


def order_dimension(
    headers: DataFrame, timeline: DataFrame, lookups: OrderLookups, excluded_publisher: str | None = None
) -> DataFrame:
    """The order dimension. Every lookup is a left join, made one row per key beforehand.

    ``timeline`` is read several times: pass a stored table (``session.stage``).
    """
    o = headers.withColumns(
        {
            "publisher": F.coalesce("publisher", F.lit("")),
            "offer_cut": text.cut_at_marker(F.col("offer")),
        }
    )
    if excluded_publisher is not None:
        o = o.where(F.col("publisher") != excluded_publisher)
    o = o.where(F.col("order_id").isNotNull())
    known = lookups.publishers.select(F.col("publisher").alias("known_publisher")).distinct()
    o = lookup(o, known.withColumn("p_key", F.col("known_publisher")), [("publisher", "p_key")])

    took = ["offer_id", "is_preview", "offer_type", "row_key"]
    exact = lookups.offers.select(
        F.col("offer").alias("x_offer"), F.col("plan").alias("x_plan"), F.col("publisher").alias("x_publisher"),
        *[F.col(c).alias(f"x_{c}") for c in took],
    )
    exact = newest(exact, ["x_offer", "x_plan", "x_publisher"], [Sort("x_row_key")])
    loose = lookups.offers.select(
        F.col("offer").alias("l_offer"), F.col("plan").alias("l_plan"),
        *[F.col(c).alias(f"l_{c}") for c in took],
    )
    loose = newest(loose, ["l_offer", "l_plan"], [Sort("l_row_key")])
    exact = exact.withColumns({"e_offer": F.col("x_offer"), "e_plan": F.col("x_plan")})
    o = lookup(o, exact, [("offer_cut", "e_offer"), ("plan", "e_plan"), ("known_publisher", "x_publisher")])
    # Rows found exactly get no key for the looser lookup.
    o = o.withColumn("loose_offer", F.when(F.col("x_offer").isNull(), F.col("offer_cut")))
    loose = loose.withColumns({"e_offer": F.col("l_offer"), "e_plan": F.col("l_plan")})
    o = lookup(o, loose, [("loose_offer", "e_offer"), ("plan", "e_plan")])
    o = o.withColumns({c: F.coalesce(f"x_{c}", f"l_{c}") for c in took if c != "row_key"})

    overrides = newest(lookups.overrides, ["publisher", "offer", "plan"], [Sort("plan_override")])
    o = lookup(o, overrides, [(c, c) for c in ("publisher", "offer", "plan")])
    o = o.withColumn("plan_key", F.coalesce("plan_override", "plan"))

    onboarding = newest(lookups.onboarding, ["offer_id", "plan"], [Sort("created_ts", True), Sort("billed_outside")])
    languages = newest(lookups.languages, ["offer_id", "plan"], [Sort("version", True), Sort("needs_licence")])
    for side, columns in (
        (onboarding, ["billed_outside"]), (languages, ["needs_licence"]), (lookups.market_prices, ["market_price"])
    ):
        o = lookup(o, side.select("offer_id", "plan", *columns), [("offer_id", "offer_id"), ("plan_key", "plan")])

    o = o.join(last_discount(timeline), "order_id", "left")
    latest = newest(
        latest_prices(timeline), ["order_id"], [Sort("event_end_name"), Sort("currency")]
    ).select("order_id", F.col("event_end_name").alias("current_status"), "latest_price",
             F.col("currency").alias("price_currency"))
    o = o.join(latest, "order_id", "left")

    outside = text.flag_text(F.col("billed_outside")) == 1
    outside = F.when(F.col("billed_outside").isNotNull(), outside)
    is_trial = F.col("discount") == states.TRIAL
    return o.select(
        "order_id", "parent_id", "subscription_id",
        F.coalesce(F.col("known_publisher"), F.trim("publisher")).alias("publisher_name"),
        F.coalesce("x_offer", "l_offer", "offer").alias("offer_name"),
        F.coalesce("x_plan", "l_plan", "plan").alias("plan_name"),
        "offer_id", "is_preview", "offer_type", F.col("x_row_key").alias("offer_row_key"),
        "purchase_ts", "cancel_ts",
        F.when(F.lower("current_status") == "converted", states.CANCELLED).otherwise(F.col("current_status")).alias(
            "current_status"
        ),
        F.col("price_currency").alias("currency"),
        F.when(is_trial, F.col("discount_end")).alias("trial_end_ts"),
        F.coalesce(is_trial.cast("int"), F.lit(0)).alias("is_trial"),
        states.billing_type(F.col("needs_licence"), outside, F.col("latest_price"), F.col("market_price")).alias(
            "billing_type"
        ),
        states.payment_type(F.col("needs_licence"), outside).alias("payment_type"),
        F.lit(0).alias("is_multi_solution"),
        F.col("order_id").alias("row_key"),
    )


def multi_resource_orders(usage: DataFrame) -> DataFrame:
    """Orders derived from the usage of multi-resource solutions: one per resource.

    usage: uri, order_id, start_ts
    """
    return (
        usage.where(F.col("order_id").isNotNull())
        .groupBy(text.lower_md5(F.col("uri")).alias("uri_hash"))
        .agg(F.min(F.lower("uri")).alias("uri"), F.min("start_ts").alias("purchase_ts"))
        .withColumns({"order_id": F.col("uri_hash"), "is_multi_solution": F.lit(1), "row_key": F.col("uri_hash")})
    )


def with_templates(orders: DataFrame, templates: DataFrame) -> DataFrame:
    """Publisher and offer of multi-resource orders, from the template whose address hashes like the resource's.

    templates: template_uri, publisher, offer. Of several templates with one address the first by name counts,
    so that no order becomes two; an order without template keeps nulls.
    """
    named = templates.select(
        text.lower_md5(F.col("template_uri")).alias("template_hash"), F.col("publisher").alias("publisher_name"), F.col("offer").alias("offer_name")
    ).where(F.col("template_hash").isNotNull())
    one = newest(named, ["template_hash"], [Sort("publisher_name"), Sort("offer_name")])
    return lookup(orders, one.withColumnRenamed("template_hash", "t_key"), [("uri_hash", "t_key")])


def with_resource_uri(orders: DataFrame, resources: DataFrame) -> DataFrame:
    """Attach the resource address of an order and its hash. resources: order_id, uri, updated_ts"""
    one = newest(resources, ["order_id"], [Sort("updated_ts", True), Sort("uri")]).select("order_id", "uri")
    return orders.join(one, "order_id", "left").withColumn("uri_hash", text.lower_md5(F.col("uri")))


def with_market_subscription(orders: DataFrame, timeline: DataFrame, billing_system: str) -> DataFrame:
    """Attach the billing id of one billing system by parent order."""
    ids = timeline.where(F.col("billing_system") == billing_system)
    ids = newest(ids, ["parent_id"], [Sort("start_ts", True), Sort("entry_id", True)])
    return orders.join(
        ids.select("parent_id", F.col("billing_id").alias("market_subscription_id")), "parent_id", "left"
    )


VALIDITY = ["enrollment", "amendment", "enrollment_account", "account_subscription"]


def subscription_channels(
    account_subscription: DataFrame, enrollment_account: DataFrame, subscriptions: DataFrame, enrollments: DataFrame
) -> DataFrame:
    """Sales channel of a subscription with its four validity intervals reduced to one.

    account_subscription: account_id, subscription_key, starts, ends; enrollment_account:
    account_id, enrollment_id, starts, ends; subscriptions: subscription_key, subscription_id;
    enrollments: enrollment_id, channel, starts, ends, amendment_starts, amendment_ends.
    Null bounds are open.
    """
    a = account_subscription.withColumnsRenamed({"starts": "as_starts", "ends": "as_ends"})
    e = enrollment_account.withColumnsRenamed({"starts": "ea_starts", "ends": "ea_ends"})
    joined = (
        a.join(e, "account_id").join(subscriptions, "subscription_key").join(enrollments, "enrollment_id")
    )
    start, end = intersect_intervals(
        ["starts", "amendment_starts", "ea_starts", "as_starts"], ["ends", "amendment_ends", "ea_ends", "as_ends"]
    )
    return joined.select("subscription_id", "channel", start.alias("valid_from"), end.alias("valid_to"))


def licence_types(
    orders: DataFrame, billing: DataFrame, subscriptions: DataFrame, channels: DataFrame, enterprise_system: str
) -> DataFrame:
    """Licence type per order from the validity of its subscription at the purchase day.

    billing: order_id, billing_system, ts; a billing row counts when its day is the purchase day.
    """
    o = orders.withColumn("purchase_day", F.to_date("purchase_ts"))
    paid = billing.where(F.col("billing_system") == enterprise_system).select(
        F.col("order_id").alias("b_order"), F.to_date("ts").alias("b_day")
    ).distinct().withColumn("enterprise", F.lit(True))
    o = o.join(
        paid,
        (F.col("order_id") == F.col("b_order"))
        & (F.col("purchase_day") == F.coalesce("b_day", "purchase_day")),
        "left",
    ).drop("b_order", "b_day")
    known = subscriptions.select(F.col("subscription_id").alias("known_subscription")).distinct()
    o = lookup(o, known.withColumn("s_key", F.col("known_subscription")), [("subscription_id", "s_key")])
    named = channels.withColumnRenamed("subscription_id", "c_subscription")
    o = interval_join(
        o, named, [("subscription_id", "c_subscription")], "purchase_day", "valid_from", "valid_to", "left"
    )
    o = newest(o, ["order_id"], [F.col("channel").asc_nulls_last(), F.col("valid_from").asc()])
    return o.withColumn(
        "licence_type",
        states.licence_type(F.col("known_subscription"), F.col("enterprise"), F.col("channel")),
    ).drop("purchase_day", "enterprise", "known_subscription", "c_subscription", "channel", "valid_from", "valid_to")


def union_orders(first: DataFrame, second: DataFrame) -> DataFrame:
    """Ordinary and multi-resource orders in one frame; absent columns become null."""
    columns = [*first.columns, *[c for c in second.columns if c not in first.columns]]

    def widened(df: DataFrame, other: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in other.schema.fields}
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])

    return checked_union(widened(first, second), widened(second, first))


def referenced_subscriptions(orders: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Subscriptions that orders refer to, whatever the case of their ids."""
    wanted = orders.select(F.lower("subscription_id").alias("wanted")).distinct()
    return subscriptions.join(wanted, F.lower("subscription_id") == F.col("wanted"), "left_semi")


# Labels of multi-resource orders.
MULTI_ORDER_TYPE, MULTI_ORDER_SOURCE = "MultiSolution", "UsageDaily MultiSolution"


@dataclass(frozen=True)
class LastSteps:
    """Frames of the last steps of the order dimension.

    * resources: order_id, uri, updated_ts
    * solution_usage: uri, order_id, start_ts
    * templates: template_uri, publisher, offer
    * billing: order_id, billing_system, ts
    * subscriptions: subscription_key, subscription_id
    * channels: result of ``subscription_channels``
    """

    resources: DataFrame
    solution_usage: DataFrame
    templates: DataFrame
    billing: DataFrame
    subscriptions: DataFrame
    channels: DataFrame
    market_system: str
    enterprise_system: str


def complete_dimension(ordinary: DataFrame, timeline: DataFrame, s: LastSteps) -> DataFrame:
    """The order dimension with resource addresses, multi-resource orders and their templates, market subscription and licence type."""
    multi = with_templates(multi_resource_orders(s.solution_usage), s.templates).withColumns(
        {"order_type": F.lit(MULTI_ORDER_TYPE), "data_source": F.lit(MULTI_ORDER_SOURCE)}
    )
    every = union_orders(with_resource_uri(ordinary, s.resources), multi)
    every = with_market_subscription(every, timeline, s.market_system)
    return licence_types(every, s.billing, s.subscriptions, s.channels, s.enterprise_system)
