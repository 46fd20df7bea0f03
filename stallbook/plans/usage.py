"""Usage facts: daily load, priced usage, multi-resource usage and the final fact.

Usage frames have: order_id, meter, uri, usage_date (date), units and any of the other group
columns. Price intervals have: order_id, meter, discount, price, start_ts, end_ts (null = open).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.functions import states, text, times
from stallbook.operators.audit import counted_audit, with_lineage
from stallbook.operators.hot import Sort, ranked
from stallbook.operators.joins import guarded_lookup, interval_matches, lookup, match_flag
from stallbook.operators.sets import checked_union, union_distinct
from stallbook.operators.windows import newest
from stallbook.session import stage
from stallbook.sources.readers import latest_publication, look_back, require_days
from stallbook.sources.writers import is_late, late_rows, write_partitioned

# Units, words looked for in resource addresses and properties, and labels.
HOURS_PER_DAY = 24
CORE_WORD = "core"
STACK_RULES = (("classiccompute", "RDFE"), ("compute", "CRP"))
UNKNOWN_STACK = "Unknown"
DATA_TRANSFER_WORD = "datatr"
SOFTWARE_PATTERN = "%compute%sw%"
GOVERNMENT_WORD = "gov"
CORE_STACK, CORE_USAGE_TYPE = "CORE", "CoreOrders"
DAILY_SOURCE, MULTI_SOURCE = "UsageDaily", "UsageDaily MultiSolution"
DEFAULT_OS_FAMILY = "linux"
OS_FAMILY_PREFIX = "iaas - "
ORACLE_IMAGE_PATTERN = "%windows\\_oracle%"
ORACLE_PRICE_TYPE = "oracle"
ORACLE_TIERS = (
    ("windows\\_oracle\\_12c\\_db%\\_ent", "Database Enterprise"),
    ("windows\\_oracle\\_12c\\_db%\\_std", "Database Standard"),
    ("windows\\_oracle\\_12c\\_wls\\_ent", "Weblogic Server Enterprise"),
    ("windows\\_oracle\\_12c\\_wls\\_std", "Weblogic Server Standard"),
)

USAGE_KEYS = [
    "order_id", "subscription_id", "meter", "uri", "region", "project", "service_info1", "service_info2",
    "usage_date", "properties", "part_number", "tags", "stack", "cores", "vm_size", "is_missing", "info", "publisher",
]


def core_quantity(machines: Column) -> Column:
    """Core hours of machines that ran all day."""
    return machines * HOURS_PER_DAY


def daily_load(
    published: DataFrame, late: DataFrame, slice_day: str, days: int, run_id: str,
    day: str = "usage_date", publication: str = "aggregatedts", late_days: int = 30,
) -> DataFrame:
    """Newest publication of each look-back day plus the late rows, flagged and with lineage.

    A day without any publication fails the load.
    """
    require_days(published, day, slice_day, days)
    recent = latest_publication(look_back(published, day, slice_day, days), day, publication)
    on_time = recent.drop(publication).withColumn("is_missing", F.lit(0))
    missed = late_rows(late, day, slice_day, late_days).withColumn("is_missing", F.lit(1))
    return with_lineage(checked_union(on_time, missed.drop(publication)), run_id)


def store_daily_load(
    published: DataFrame, late: DataFrame, slice_day: str, days: int, run_id: str, path: str, loaded_at: Column,
    day: str = "usage_date", publication: str = "aggregatedts", late_days: int = 30,
) -> DataFrame:
    """Write the daily load by day and missing flag; returns its two audit rows.

    An overwrite replaces the days of the load alone. One audit row counts the stored rows, the other the
    late rows among them; both are counted while the rows are written, so nothing is read again.
    """
    loaded = daily_load(published, late, slice_day, days, run_id, day, publication, late_days)
    counted = write_partitioned(loaded, path, [day, "is_missing"], counts={
        "Usage": F.lit(True), "MissingUsage": (F.col("is_missing") == 1) & is_late(day, slice_day, late_days),
    })
    spark, slice_id = loaded.sparkSession, slice_day.replace("-", "")
    whole, missed = (counted_audit(spark, counted[s], s, slice_id, path, run_id, loaded_at) for s in ("Usage", "MissingUsage"))
    return whole.unionByName(missed)


def described_usage(usage: DataFrame) -> DataFrame:
    """Add core count, machine size and stack, as far as the source columns are present."""
    added = {"cores": text.core_count(F.col("meter"))}
    if "info" in usage.columns:
        added["vm_size"] = text.quoted_field(F.col("info"))
    if "uri" in usage.columns:
        added["stack"] = text.classify_text(F.col("uri"), list(STACK_RULES), UNKNOWN_STACK)
        added["uri"] = F.lower("uri")
    return usage.withColumns({c: e for c, e in added.items() if c not in usage.columns or c == "uri"})


def billable(usage: DataFrame, since: str, core_meters: bool, excluded_order: object | None = None) -> DataFrame:
    """Usage with an order and part number from a day on, of core meters or of all others."""
    is_core = text.contains_text(F.col("meter"), CORE_WORD)
    rows = usage.where(
        F.col("order_id").isNotNull() & F.col("part_number").isNotNull()
        & (F.col("usage_date") >= F.lit(since).cast("date"))
    ).where(is_core if core_meters else ~is_core)
    if excluded_order is None:
        return rows
    return rows.where(F.col("order_id") != excluded_order)


def prices_in_force(usage: DataFrame, intervals: DataFrame) -> DataFrame:
    """One price per order, meter and usage day: in force at 23:59:59 of the day."""
    points = usage.select("order_id", "meter", "usage_date").distinct()
    points = points.withColumn("point", times.end_of_day(F.col("usage_date")))
    own = intervals.select(
        F.col("order_id").alias("i_order"), F.col("meter").alias("i_meter"), "discount", "price", "start_ts", "end_ts"
    )
    held = interval_matches(points, own, [("order_id", "i_order"), ("meter", "i_meter")], "point", "start_ts", "end_ts")
    one = newest(
        held, ["order_id", "meter", "point"],
        [F.col("end_ts").desc_nulls_first(), Sort("start_ts", True), Sort("price"), Sort("discount")],
    )
    return one.select(
        "order_id", "meter", F.to_date("point").alias("usage_date"), F.lit(True).alias("f_found"),
        F.col("discount").alias("f_discount"), F.col("price").alias("f_price"),
    )


def next_used_day(asked: DataFrame, used: DataFrame, keys: list[str], day: str) -> DataFrame:
    """keys, ``day`` and ``next_day``: the first used day on or after each asked day, null if none.

    Both sides are made distinct first, so a key has at most two rows per calendar day.
    """
    used_days = used.select(*keys, day).distinct().withColumn("used_day", F.col(day))
    asked_days = asked.select(*keys, day).distinct().withColumn("used_day", F.lit(None).cast("date"))
    ahead = Window.partitionBy(*keys).orderBy(day, F.col("used_day").asc_nulls_first())
    found = used_days.unionByName(asked_days).withColumn(
        "next_day", F.first("used_day", ignorenulls=True).over(ahead.rowsBetween(0, Window.unboundedFollowing))
    )
    return found.where(F.col("used_day").isNull()).select(*keys, day, "next_day")


def latest_prices(usage: DataFrame, intervals: DataFrame, as_of: Column) -> DataFrame:
    """The price to fall back on per order and meter.

    Of the intervals that last longer than a second, the one that ends last counts for each
    start day, widened to whole days. Of those that hold the end of some usage day of the order
    and meter, the one that ends last is taken, the later start day first.
    """
    keys = ["order_id", "meter"]
    lasting = intervals.where(times.seconds_between(F.col("start_ts"), F.coalesce("end_ts", as_of)) > 1)
    widened = lasting.withColumns({"day": F.to_date("start_ts"), "last_day": F.to_date("end_ts")})
    daily = newest(
        widened, [*keys, "day"],
        [F.col("end_ts").desc_nulls_first(), Sort("start_ts", True), Sort("price"), Sort("discount")],
    )
    days = usage.select(*keys, F.col("usage_date").alias("day"))
    answers = next_used_day(daily, days, keys, "day")
    held = lookup(daily, answers, [(c, c) for c in (*keys, "day")]).where(
        F.col("next_day").isNotNull() & (F.col("last_day").isNull() | (F.col("next_day") <= F.col("last_day")))
    )
    one = newest(held, keys, [F.col("last_day").desc_nulls_first(), Sort("day", True), Sort("price"), Sort("discount")])
    return one.select(
        "order_id", "meter", F.lit(True).alias("n_found"), F.col("discount").alias("n_discount"),
        F.col("price").alias("n_price"),
    )


def price_side(usage: DataFrame, intervals: DataFrame, known_orders: DataFrame, as_of: Column) -> DataFrame:
    """All that prices depend on, one row per order and meter in use: prices by day in force, last price, and whether the order is known.

    A row holds at most one entry per calendar day.
    """
    keys = ["order_id", "meter"]
    force = prices_in_force(usage, intervals).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("usage_date", F.struct("f_discount", "f_price")))).alias("by_day")
    )
    known = known_orders.select("order_id").distinct().withColumn("is_known", F.lit(True))
    side = lookup(usage.select(*keys).distinct(), force, [(c, c) for c in keys])
    side = lookup(side, latest_prices(usage, intervals, as_of), [(c, c) for c in keys])
    return lookup(side, known, [("order_id", "order_id")])


def priced_usage(
    usage: DataFrame, intervals: DataFrame, known_orders: DataFrame, as_of: Column,
    keys: list[str] = USAGE_KEYS, units: Column | None = None,
) -> DataFrame:
    """Units per keys with the price state of the order on that day.

    Keys must contain order_id, meter and usage_date, on which alone the state depends; so
    usage is rolled up before the lookups, which then see one row per group. The three lookups
    are one side (``price_side``), so the roll-up moves once to meet them. A missing price
    falls back to the last one in force on some usage day of the order and meter (``latest_prices``).
    """
    rolled = usage.groupBy(*keys).agg(F.sum(F.col("units") if units is None else units).alias("quantity"))
    # The days in use per order and meter, which all lookups start from, are worked out once.
    days = stage(usage.select("order_id", "meter", "usage_date").distinct(), "used-days")
    # Only intervals of orders and meters in use are swept and ranked.
    pairs = days.select("order_id", "meter").distinct()
    intervals = stage(lookup(intervals, pairs, [("order_id", "order_id"), ("meter", "meter")], "left_semi"), "used-intervals")
    wide = lookup(rolled, price_side(days, intervals, known_orders, as_of), [("order_id", "order_id"), ("meter", "meter")])
    force = F.try_element_at("by_day", F.col("usage_date"))
    state = states.price_state(force.isNotNull(), force["f_discount"], force["f_price"], F.col("is_known").isNotNull())
    wide = wide.withColumn("state", state)
    fallback = states.priced_state(
        F.col("n_found").isNotNull(), F.col("n_discount"), F.col("n_price"), F.lit(states.MISSING_PRICE)
    )
    final = F.when(F.col("state") == states.MISSING_PRICE, fallback).otherwise(F.col("state"))
    result = wide.withColumn("state", final).select(*keys, "quantity", "state")
    if "cores" in keys:
        result = result.withColumn("core_quantity", F.col("quantity") * F.col("cores"))
    return result


def usage_fact_rows(priced: DataFrame, usage_type: str, is_machine: int) -> DataFrame:
    """The common columns of a fact step."""
    return priced.withColumns(
        {
            "uri_hash": text.lower_md5(F.col("uri")),
            "tags": F.coalesce("tags", F.lit("")),
            "is_core_image": F.lit(0),
            "is_multi_solution": F.lit(0),
            "is_vm_usage": F.lit(is_machine),
            "usage_data_source": F.lit(DAILY_SOURCE),
            "usage_type": F.lit(usage_type),
            "row_key": F.col("order_id"),
        }
    )


def core_order_rows(profiles: DataFrame) -> DataFrame:
    """Fact rows of core machines, from their profiles: a full day of hours per machine."""
    none = F.lit(None).cast("string")
    columns = {
        "order_id": none, "meter": none, "uri": none, "uri_hash": none, "region": F.col("location"),
        "cores": F.col("vp_count"), "vm_size": F.col("size"), "tags": F.lit(""),
        "quantity": core_quantity(F.col("quantity_vms").cast("double")),
        "core_quantity": F.col("usage_hours").cast("double"), "is_core_image": F.lit(1),
        "is_multi_solution": F.lit(0), "is_vm_usage": F.lit(1), "usage_data_source": F.col("data_source"),
        "stack": F.lit(CORE_STACK), "state": F.lit(states.UNKNOWN), "info": none,
        "subscription_id": F.col("subscription_id"), "publisher": F.col("publisher_name"),
        "usage_type": F.lit(CORE_USAGE_TYPE), "vm_id": F.col("vm_id"), "usage_date": F.to_date("ts"),
        "is_missing": F.lit(0), "row_key": F.col("vm_id"),
    }
    return profiles.select(*[e.alias(c) for c, e in columns.items()])


def core_prices(records: DataFrame, intervals: DataFrame) -> DataFrame:
    """Prices of core meters in force at midnight of some day on which cores of that size ran.

    records: vp_count, ts. For every start day the next day with usage is looked up, among at
    most one row per meter and calendar day; no interval is paired with all days it spans.
    """
    used = records.select(text.core_meter(F.col("vp_count")).alias("meter"), F.to_date("ts").alias("day"))
    start_day = F.to_date("start_ts")
    midnight = start_day.cast("timestamp_ntz") == F.col("start_ts")
    dated = intervals.withColumn("first_day", F.when(midnight, start_day).otherwise(F.date_add(start_day, 1)))
    asked = dated.select("meter", F.col("first_day").alias("day"))
    answers = next_used_day(asked, used, ["meter"], "day").withColumnRenamed("day", "first_day")
    held = lookup(dated, answers, [("meter", "meter"), ("first_day", "first_day")]).where(
        F.col("next_day").isNotNull()
        & (F.col("end_ts").isNull() | (F.col("next_day").cast("timestamp_ntz") <= F.col("end_ts")))
    )
    return held.select("order_id", "meter", "discount", "price").distinct()


def software_state(info: Column) -> Column:
    """Paid when the properties name compute software, else Free."""
    return F.when(text.like_any_case(info, SOFTWARE_PATTERN), states.PAID).otherwise(states.FREE)


def unbilled_usage(usage: DataFrame, listed: DataFrame, billed: DataFrame, since: str) -> DataFrame:
    """Usage of listed resources that is not already billed under an order.

    ``listed`` has uri; ``billed`` is usage that carries an order: a row with the same resource,
    day and units is billed. Data transfer is left out on both sides.
    """
    def no_transfer(df: DataFrame) -> DataFrame:
        return df.where(F.coalesce(~F.lower("info").contains(DATA_TRANSFER_WORD), F.lit(False)))

    rows = no_transfer(usage).where(F.col("usage_date") >= F.lit(since).cast("date")).withColumn("uri", F.lower("uri"))
    wanted = listed.select(F.lower("uri").alias("uri"))
    paid = no_transfer(billed).where(F.col("order_id").isNotNull()).select(
        F.lower("uri").alias("uri"), "usage_date", "units"
    )
    return rows.join(wanted, "uri", "left_semi").join(paid, ["uri", "usage_date", "units"], "left_anti")


def multi_resource_usage(unbilled: DataFrame, sizes: DataFrame, keys: list[str], units: Column | None = None) -> DataFrame:
    """Unbilled usage rolled up, with cores by machine size. sizes: vm_size, cores (unique size)"""
    amount = F.col("units") if units is None else units
    grouped = unbilled.withColumn("state", software_state(F.col("info"))).groupBy(*keys, "state").agg(
        F.sum(amount).alias("quantity")
    )
    cores = sizes.select(F.col("vm_size").alias("s_size"), F.col("cores").alias("cores"))
    return grouped.join(cores, F.col("vm_size") == F.col("s_size"), "left").drop("s_size").withColumns(
        {
            "core_quantity": F.col("quantity") * F.coalesce("cores", F.lit(1)),
            "uri_hash": F.md5("uri"),
            "usage_data_source": F.lit(MULTI_SOURCE),
            "is_multi_solution": F.lit(1),
        }
    )


def price_list(calculator: DataFrame, missing: DataFrame) -> DataFrame:
    """One list of machine prices from the calculator and from the additions kept by hand.

    calculator: tier, name, vm_type, series, cores, price; missing: vm_size, vm_type, series,
    cores, tier, price
    """
    full = F.concat("tier", F.lit("_"), "name")
    size = F.when(F.lower(full).contains("v2"), F.regexp_replace(F.lower(full), "v2", "_v2")).otherwise(full)
    columns = ["vm_size", "vm_type", "series", "cores", "tier", "price"]
    listed = calculator.select(size.alias("vm_size"), *columns[1:])
    return union_distinct(listed, missing.select(*columns))


def first_known_sizes(usage: DataFrame, keys: list[str], take: list[str]) -> DataFrame:
    """The first size seen per machine, resource, meter and cores, where something was used."""
    used = usage.where(F.col("vm_size").isNotNull() & (F.col("quantity") != 0))
    rest = [Sort(c) for c in take if c not in ("vm_size", "usage_date")]
    one = newest(used, keys, [Sort("usage_date"), Sort("vm_size"), *rest])
    return one.select(*keys, *take)


# A size is looked up by machine, resource and meter; the latter two as ``blind_keys`` makes them.
SIZE_KEYS = ["row_key", "uri_key", "meter_key"]


def blind_keys() -> dict[str, Column]:
    """Resource and meter as keys: case-blind, null and empty alike."""
    return {f"{c}_key": F.coalesce(F.lower(c), F.lit("")) for c in ("uri", "meter")}


def blind_keyed(df: DataFrame) -> DataFrame:
    """Add the blind keys that are not there yet."""
    return df.withColumns({c: e for c, e in blind_keys().items() if c not in df.columns})


def os_family(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), OS_FAMILY_PREFIX, "")


def reflag_multi_resource(usage: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows whose resource belongs to a multi-resource order change source and state."""
    flagged = match_flag(usage, orders, F.lower("uri_hash"), F.lower(F.col("uri_hash")), "__multi")
    hit = F.col("__multi") == 1
    return flagged.withColumns(
        {
            "is_multi_solution": F.when(hit, 1).otherwise(F.col("is_multi_solution")),
            "usage_data_source": F.when(hit, MULTI_SOURCE).otherwise(F.col("usage_data_source")),
            "state": F.when(hit, software_state(F.col("info"))).otherwise(F.col("state")),
        }
    ).drop("__multi")


def special_tier(image: Column, rules: tuple[tuple[str, str], ...] = ORACLE_TIERS) -> Column:
    chain = None
    for pattern, tier in rules:
        hit = text.like_any_case(image, pattern)
        chain = F.when(hit, tier) if chain is None else chain.when(hit, tier)
    return chain


@dataclass(frozen=True)
class FactLookups:
    """Frames of the final fact.

    * orders: row_key, subscription_id, cancelled (null = not cancelled), vm_id
    * sizes: row_key, uri, meter (or their ``blind_keys``), usage_date, vm_size, os_name, os_family, cores
    * prices: vm_size, vm_type, series, cores, tier, price
    """

    orders: DataFrame
    sizes: DataFrame
    prices: DataFrame


def usage_fact(usage: DataFrame, lookups: FactLookups, special_pattern: str = ORACLE_IMAGE_PATTERN) -> DataFrame:
    """The final fact: size and subscription filled in, after-cancel flag, list price and cost.

    Equal usage rows count once. Every lookup has one row per key as it is joined (sizes: case-blind,
    null and empty alike), so no usage row becomes two and no quantity is counted twice.

    Usage moves twice: by the keys of the sizes, where equal rows meet as well, and by row_key to the orders.
    """
    orders = newest(lookups.orders, ["row_key"], [Sort("subscription_id"), Sort("vm_id")]).select(
        F.col("row_key").alias("o_key"), F.col("subscription_id").alias("o_subscription"), "cancelled",
        F.col("vm_id").alias("o_vm"),
    )
    rest = [Sort(c) for c in ("vm_size", "os_name", "os_family", "cores")]
    # Sizes that were ranked by these keys lie by them already, so neither this rank nor the join moves them.
    sizes = newest(blind_keyed(lookups.sizes), SIZE_KEYS, [Sort("usage_date"), *rest]).select(
        *[F.col(c).alias(f"z_{c}") for c in SIZE_KEYS], F.col("vm_size").alias("z_size"), F.col("os_name").alias("z_os"),
        F.col("os_family").alias("z_family"), F.col("cores").alias("z_cores"),
    )
    plain = newest(
        lookups.prices.where(F.lower("vm_type") != ORACLE_PRICE_TYPE), ["vm_size", "vm_type"], [Sort("price")]
    ).select(F.col("vm_size").alias("p_size"), F.col("vm_type").alias("p_type"), F.col("price").alias("p_price"))
    special = newest(
        lookups.prices.where(F.lower("vm_type") == ORACLE_PRICE_TYPE), ["series", "cores", "tier"], [Sort("price")]
    ).select(
        F.col("series").alias("q_series"), F.col("cores").alias("q_cores"), F.col("tier").alias("q_tier"),
        F.col("price").alias("q_price"),
    )
    on = [F.col("row_key") == F.col("z_row_key"), *[e == F.col(f"z_{c}") for c, e in blind_keys().items()]]
    # Equal rows lie together by these keys already.
    wide = blind_keyed(usage.join(sizes, on, "left").drop(*[f"z_{c}" for c in SIZE_KEYS])).distinct()
    is_special = text.like_any_case(F.col("z_os"), special_pattern)
    size = F.coalesce("vm_size", "z_size")
    wide = guarded_lookup(
        wide, is_special,
        (special, [
            F.substring(F.get(F.split(size, "_"), F.lit(1)), 1, 1) == F.col("q_series"),
            F.col("z_cores") == F.col("q_cores"), special_tier(F.col("z_os")) == F.col("q_tier"),
        ]),
        (plain, [
            F.coalesce("vm_size", F.regexp_replace("z_size", ",", "")) == F.col("p_size"),
            F.coalesce(os_family(F.col("z_family")), F.lit(DEFAULT_OS_FAMILY)) == F.col("p_type"),
        ]),
    )
    price = F.when(is_special, F.col("q_price")).otherwise(F.col("p_price"))
    priced = wide.withColumns({"vm_size": size, "default_price": price}).select(*usage.columns, "default_price")
    added = {
        "subscription_id": F.col("o_subscription"), "vm_id": F.col("o_vm"),
        "after_cancel": times.after_cancel(F.col("usage_date"), F.col("cancelled")),
    }
    names = [*usage.columns, *[c for c in added if c not in usage.columns], "default_price"]
    found = lookup(priced, orders, [("row_key", "o_key")]).withColumns(added).select(*names)
    return found.withColumn("influenced_cost", F.col("quantity") * F.col("default_price"))


def usage_locations(usage: DataFrame, order: str, region: str, day: str, tie_breakers: list[str],
                    word: str = GOVERNMENT_WORD) -> DataFrame:
    """Each usage row of an order with its recency rank and whether any region of the order
    contains the word."""
    placed = usage.where(F.col(region).isNotNull())
    special = usage.where(text.contains_text(F.col(region), word))
    flagged = match_flag(placed, special, F.col(order), F.col(order), "in_special_region")
    return ranked(flagged, [order], [Sort(day, True), *[Sort(c) for c in tie_breakers]], "location_rank")


# Columns of the staged fact, whatever step a row comes from.
FACT_COLUMNS = {
    "order_id": "string", "subscription_id": "string", "meter": "string", "uri": "string", "uri_hash": "string", "region": "string",
    "project": "string", "service_info1": "string", "service_info2": "string", "part_number": "string", "tags": "string", "stack": "string",
    "cores": "double", "vm_size": "string", "info": "string", "publisher": "string", "state": "string", "quantity": "double",
    "core_quantity": "double", "usage_date": "date", "is_missing": "int", "is_core_image": "int", "is_multi_solution": "int", "is_vm_usage": "int",
    "usage_data_source": "string", "usage_type": "string", "vm_id": "string", "row_key": "string",
}
MACHINE_USAGE, METERED_USAGE, MULTI_USAGE = "Machine", "Metered", "MultiSolution"
RUN, STEP = "run_id", "step"


def fact_rows(rows: DataFrame) -> DataFrame:
    """Rows of a step with all columns of the staged fact; those that the step does not know are null."""
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in FACT_COLUMNS.items()])


@dataclass(frozen=True)
class UsageSteps:
    """Results of the first four steps: priced usage of machines and of other meters, machine profiles, multi-resource usage."""

    machines: DataFrame
    metered: DataFrame
    profiles: DataFrame
    multi: DataFrame

    def staged(self) -> UsageSteps:
        """The same results worked out once, for runs that store them again."""
        return UsageSteps(*[stage(getattr(self, f.name), f"step-{f.name}") for f in fields(self)])

    def rows(self) -> dict[str, DataFrame]:
        multi = self.multi.withColumns({"row_key": F.col("uri_hash"), "usage_type": F.lit(MULTI_USAGE), "is_core_image": F.lit(0), "is_vm_usage": F.lit(0)})
        return {
            "1": usage_fact_rows(self.machines, MACHINE_USAGE, 1), "2": usage_fact_rows(self.metered, METERED_USAGE, 0),
            "3": core_order_rows(self.profiles), "4": multi,
        }


def store_steps(steps: UsageSteps, path: str, run_id: str) -> DataFrame:
    """Write the steps into one fact, partitioned by run and step, and read the run back. A repeated run replaces its own rows.

    All rows of a step belong to one folder, so they are written as they lie.
    """
    for step, rows in steps.rows().items():
        named = fact_rows(rows).withColumns({RUN: F.lit(run_id), STEP: F.lit(step)})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN, STEP).parquet(path)
        spark = named.sparkSession
    return spark.read.schema(named.schema).parquet(path).where(F.col(RUN) == run_id).drop(RUN, STEP)


def usage_job(
    steps: UsageSteps, orders: DataFrame, prices: DataFrame, multi_orders: DataFrame, staging: str, path: str, run_id: str,
) -> dict[str, int]:
    """The usage fact from its five steps, written by day and missing flag; returns the number of rows written.

    orders and prices as in ``FactLookups``; multi_orders has uri_hash. Sizes are the first known ones of the
    staged rows. An overwrite replaces the days of the run alone.
    """
    staged = store_steps(steps, staging, run_id)
    none = F.lit(None).cast("string")
    sizes = first_known_sizes(
        blind_keyed(staged).withColumns({"os_name": none, "os_family": none}), SIZE_KEYS, ["vm_size", "usage_date", "os_name", "os_family", "cores"]
    )
    fact = usage_fact(reflag_multi_resource(staged, multi_orders), FactLookups(orders, sizes, prices))
    whole = with_lineage(fact.withColumn("is_missing", F.coalesce("is_missing", F.lit(0))), run_id)
    return write_partitioned(whole, path, ["usage_date", "is_missing"], counts={"rows": F.lit(True)})
