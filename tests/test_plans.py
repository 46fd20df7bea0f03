from datetime import date, datetime

from pyspark.sql import functions as F

from stallbook.functions.times import ntz
from stallbook.operators.hot import Sort
from stallbook.operators.merge import DimensionSpec
from stallbook.plans import core_usage, orders, usage
from stallbook.plans.publish import previous_rows, publish

BASE = datetime(2024, 1, 1)

HISTORY = "entry_id int, parent_id string, name string, ts timestamp_ntz, watermark int, price double, currency string"


def at(text):
    return datetime.fromisoformat(f"2024-01-{text}")


def _history(spark, *events):
    data = [(i, p, n, at(t), i, float(v), "USD") for i, (p, n, t, v) in enumerate(events)]
    return spark.createDataFrame(data, HISTORY)


def test_timeline_of_a_cancelled_order(spark, rows):
    history = _history(
        spark,
        ("p", "Placed", "01 00:00:00", 5), ("p", "Trial Ended", "03 00:00:00", 6), ("p", "Canceled", "09 00:00:00", 6),
        ("p", "Price Changed", "10 00:00:00", 7),
    )
    got = orders.price_timeline(history)
    assert rows(got, "event_start_name", "event_end_name", "discount", "start_ts", "end_ts", "price") == [
        ("Placed", "Trial Ended", "Trial", at("01 00:00:00"), at("02 23:59:59"), 5.0),
        ("Trial Ended", "Cancelled", "None", at("03 00:00:00"), at("08 23:59:59"), 6.0),
    ]


def test_timeline_of_a_single_event_is_open(spark):
    row = orders.price_timeline(_history(spark, ("p", "Placed", "01 00:00:00", 5))).first()
    assert (row.event_end_name, row.end_ts, row.meter, row.order_id) == ("Active", None, "Monthly", "p")


def test_first_price_change_and_event_before_placing_are_dropped(spark, rows):
    history = _history(
        spark, ("a", "Price Changed", "01 00:00:00", 1), ("a", "Renewed", "02 00:00:00", 2),
        ("b", "Prepared", "01 00:00:00", 1), ("b", "Placed", "02 00:00:00", 2),
    )
    assert rows(orders.price_timeline(history), "parent_id", "event_start_name") == [("a", "Renewed"), ("b", "Placed")]


def test_repeats_within_a_second_are_dropped(spark, rows):
    history = _history(
        spark, ("p", "Placed", "01 00:00:00.100", 1), ("p", "Placed", "01 00:00:00.900", 2), ("p", "Renewed", "05 00:00:00", 3),
    )
    assert rows(orders.price_timeline(history), "price") == [(1.0,), (3.0,)]


def test_announced_trial_end_is_still_active(spark, rows):
    history = _history(spark, ("p", "Placed", "01 00:00:00", 1), ("p", "Trial Ended", "20 00:00:00", 2))
    got = orders.price_timeline(history, as_of=ntz("2024-01-10 00:00:00"))
    assert rows(got, "event_end_name") == [("Active",), ("Active",)]


def test_meters_fan_out_and_replace_the_price(spark, rows):
    history = _history(spark, ("p", "Placed", "01 00:00:00", 5), ("p", "Renewed", "03 00:00:00", 6))
    meters = spark.createDataFrame([(1, 0, "2core", 0.1), (2, 0, "4core", 0.2)], "meter_id int, entry_id int, meter string, amount double")
    got = orders.price_timeline(history, meters=meters)
    assert rows(got, "entry_id", "meter", "price") == [(0, "2core", 0.1), (0, "4core", 0.2), (1, "Monthly", 6.0)]


ALTERNATE = "parent_id string, ts timestamp_ntz, alternate_id string"
BILLING = "parent_id string, ts timestamp_ntz, billing_id string, billing_system string"


def test_ids_are_filled_down_from_two_rows_back(spark, rows):
    history = _history(spark, *[("p", "Renewed", f"0{d} 00:00:00", d) for d in range(1, 6)])
    alternates = orders.alternate_ids(spark.createDataFrame([("p", at("01 00:00:00"), "x" * 4 + "a" * 36), ("p", at("02 00:00:00"), "short")], ALTERNATE))
    billing = spark.createDataFrame([("p", at("03 00:00:00"), "b1", "EA")], BILLING)
    events = orders.fill_down(orders.identified_history(history, alternates, billing))
    a = "a" * 36
    assert rows(events, "entry_id", "order_id", "billing_id") == [
        (0, a, None), (1, a, None), (2, a, "b1"), (3, None, "b1"), (4, None, "b1"),
    ]


def test_billing_equal_to_the_order_id_is_left_out(spark, rows):
    history = _history(spark, ("p", "Placed", "01 00:00:00", 1), ("p", "Renewed", "02 00:00:00", 1))
    a = "a" * 36
    alternates = spark.createDataFrame([("p", at("01 00:00:00"), a), ("p", at("02 00:00:00"), a)], ALTERNATE)
    billing = spark.createDataFrame([("p", at("01 00:00:00"), a, "EA"), ("p", at("02 00:00:00"), "b", "EA")], BILLING)
    assert rows(orders.identified_history(history, alternates, billing), "entry_id", "billing_id") == [(1, "b")]


def test_migrated_parents_keep_one_row_per_order_and_bill(spark, rows):
    history = _history(
        spark, ("m", "Placed", "01 00:00:00", 1), ("m", "External Billing Migrated", "02 00:00:00", 1), ("m", "Renewed", "03 00:00:00", 1),
        ("n", "Placed", "01 00:00:00", 1), ("n", "Renewed", "02 00:00:00", 1),
    )
    billing = spark.createDataFrame([("m", at("01 00:00:00"), "b", "EA")], BILLING)
    events = orders.fill_down(orders.identified_history(history, None, billing))
    assert rows(events, "entry_id", "billing_id") == [(1, "b"), (2, None), (3, None), (4, None)]


def test_price_keys_are_unique(spark):
    history = _history(spark, ("p", "Placed", "01 00:00:00", 5), ("p", "Renewed", "03 00:00:00", 6))
    timeline = orders.price_timeline(history)
    keyed = orders.keyed_prices(timeline.unionByName(timeline))
    assert keyed.count() == keyed.select("row_key").distinct().count() == 2


def test_intervals_of_a_licence_must_all_hold(spark, rows):
    day = "date"
    pairs = spark.createDataFrame([(1, 10, date(2024, 1, 5), None)], f"account_id int, subscription_key int, starts {day}, ends {day}")
    accounts = spark.createDataFrame([(1, 7, None, date(2024, 1, 20))], f"account_id int, enrollment_id int, starts {day}, ends {day}")
    subscriptions = spark.createDataFrame([(10, "s")], "subscription_key int, subscription_id string")
    enrollments = spark.createDataFrame(
        [(7, "Indirect Enterprise", None, None, date(2024, 1, 3), date(2024, 1, 15))],
        f"enrollment_id int, channel string, starts {day}, ends {day}, amendment_starts {day}, amendment_ends {day}",
    )
    channels = orders.subscription_channels(pairs, accounts, subscriptions, enrollments)
    assert rows(channels) == [("s", "Indirect Enterprise", date(2024, 1, 5), date(2024, 1, 15))]
    bought = spark.createDataFrame(
        [("a", "s", at("05 08:00:00")), ("b", "s", at("04 08:00:00")), ("c", "s", at("16 08:00:00")), ("d", None, at("06 08:00:00"))],
        "order_id string, subscription_id string, purchase_ts timestamp_ntz",
    )
    billing = spark.createDataFrame([("c", "EA", at("16 23:00:00"))], "order_id string, billing_system string, ts timestamp_ntz")
    got = orders.licence_types(bought, billing, subscriptions, channels, "EA")
    assert rows(got, "order_id", "licence_type") == [
        ("a", "Indirect Enterprise"), ("b", "PAYG"), ("c", "Direct Enterprise"), ("d", "PAYG"),
    ]


USAGE = "order_id string, meter string, usage_date date, units double"
INTERVALS = "order_id string, meter string, discount string, price double, start_ts timestamp_ntz, end_ts timestamp_ntz"


def test_priced_usage_states(spark, rows):
    intervals = spark.createDataFrame(
        [
            ("o", "2core", "None", 3.0, at("02 00:00:00"), at("04 12:00:00")), ("o", "2core", "Trial", 0.0, at("04 12:00:01"), None),
            ("q", "2core", "None", 0.0, at("01 00:00:00"), at("01 00:00:01")),
        ],
        INTERVALS,
    )
    rows_in = spark.createDataFrame(
        [("o", "2core", date(2024, 1, d), 1.5) for d in (1, 2, 4, 9)] + [("q", "2core", date(2024, 1, 5), 1.0), ("z", "x", date(2024, 1, 5), 1.0)]
        + [("o", "2core", date(2024, 1, 2), 0.5)],
        USAGE,
    )
    known = spark.createDataFrame([("o",), ("q",)], "order_id string")
    got = usage.priced_usage(
        usage.described_usage(rows_in), intervals, known, ntz("2024-02-01 00:00:00"), ["order_id", "meter", "usage_date", "cores"]
    )
    assert rows(got.withColumn("d", F.dayofmonth("usage_date")), "order_id", "d", "quantity", "core_quantity", "state") == [
        ("o", 1, 1.5, 3.0, "Trial"), ("o", 2, 2.0, 4.0, "Paid"), ("o", 4, 1.5, 3.0, "Trial"), ("o", 9, 1.5, 3.0, "Trial"),
        ("q", 5, 1.0, 2.0, "OrderAPI Missing Price"), ("z", 5, 1.0, None, "OrderAPI Missing Order"),
    ]


def test_billed_usage_and_data_transfer_are_left_out(spark, rows):
    schema = "uri string, usage_date date, units double, info string, order_id string"
    d = date(2024, 1, 1)
    rows_in = spark.createDataFrame(
        [("U/1", d, 1.0, "compute sw", None), ("u/1", d, 2.0, "compute", None), ("u/1", d, 3.0, "DataTrIn", None), ("u/2", d, 1.0, "compute", None), ("u/3", d, 1.0, None, None)],
        schema,
    )
    billed = spark.createDataFrame([("U/1", d, 2.0, "compute", "o"), ("u/1", d, 1.0, "compute", None)], schema)
    listed = spark.createDataFrame([("u/1",), ("U/3",)], "uri string")
    got = usage.unbilled_usage(rows_in, listed, billed, "2024-01-01")
    assert rows(got, "uri", "units") == [("u/1", 1.0)]


def test_profile_takes_the_newest_record_and_the_best_metadata(spark):
    columns = {
        "vm_id": "string", "record_id": "int", "ts": "timestamp_ntz", "location": "string", "cloud": "string", "size": "string", "vp_count": "int",
        "subscription_id": "string", "publisher": "string", "data_source": "string", "quantity_vms": "int", "usage_hours": "int",
        "billing_context": "string", "image_name": "string", "image_type": "string", "crp_offer": "string", "crp_sku": "string",
        "crp_publisher": "string", "mapped_publisher": "string",
    }
    base = dict.fromkeys(columns)

    def row(**values):
        return tuple((base | values)[c] for c in columns)

    records = spark.createDataFrame(
        [
            row(vm_id="v", record_id=1, ts=at("01 00:00:00"), location="US Gov East", publisher="Oracle Linux", billing_context="linux_a", image_name="x__s1"),
            row(vm_id="v", record_id=2, ts=at("05 00:00:00"), location="West", publisher="Oracle on Windows", billing_context="windows_b"),
            row(vm_id="", record_id=3, ts=at("05 00:00:00")),
            row(vm_id="w", record_id=4, ts=at("05 00:00:00"), publisher="nobody", billing_context="c", crp_sku="k", image_type="User"),
        ],
        ", ".join(f"{c} {t}" for c, t in columns.items()),
    )
    got = {r.vm_id: r for r in core_usage.machine_profiles(records).collect()}
    v, w = got["v"], got["w"]
    assert set(got) == {"v", "w"}
    assert (v.location, v.first_seen, v.has_used_gov_cloud, v.is_gov) == ("West", at("01 00:00:00"), 1, 0)
    assert (v.sku, v.os_type, v.plan_key, v.publisher_name) == ("s1", "Linux", "Oracle on Windows:linux_a:s1", "msopentech")
    assert (w.sku, w.publisher_name, w.has_used_gov_cloud) == ("k USER", None, 0)


def test_core_prices_need_a_day_of_use_inside(spark, rows):
    records = spark.createDataFrame([(2, at("05 10:00:00")), (2, at("05 11:00:00")), (0, at("07 00:00:00"))], "vp_count int, ts timestamp_ntz")
    intervals = spark.createDataFrame(
        [
            ("a", "2core", "None", 1.0, at("05 00:00:00"), at("05 00:00:00")), ("b", "2core", "None", 2.0, at("05 00:00:01"), None),
            ("c", "2core", "None", 3.0, at("01 00:00:00"), at("04 23:59:59")), ("d", "2core", "None", 4.0, at("01 00:00:00"), None),
            ("e", "4core", "None", 5.0, at("01 00:00:00"), None), ("d", "2core", "None", 4.0, at("02 00:00:00"), at("06 00:00:00")),
        ],
        INTERVALS,
    )
    assert rows(usage.core_prices(records, intervals), "order_id", "price") == [("a", 1.0), ("d", 4.0)]


def test_publish_reads_the_newest_earlier_slice(spark, rows, tmp_path):
    spec = DimensionSpec("k", (Sort("v", True),), "source", "pubportal", ("k",))
    schema = "k string, v int, source string"
    root = str(tmp_path)
    assert previous_rows(spark, f"{root}/merged", 20240101) is None
    for slice_id, data in ((20240101, [("A", 1, "pubportal"), ("b", 1, "pubportal")]), (20240103, [("B", 3, "pubportal")]), (20240102, [("a", 2, "pubportal")])):
        day = f"{str(slice_id)[:4]}-{str(slice_id)[4:6]}-{str(slice_id)[6:]}"
        merged, history = publish(spark.createDataFrame(data, schema), spec, root, slice_id, ntz(f"{day} 00:00:00"))
    assert rows(spark.read.parquet(merged), "k", "v") == [("a", 2), ("b", 1)]
    assert spark.read.parquet(history).where("end_ts is null").count() == 2
    assert rows(previous_rows(spark, f"{root}/merged", 20240109), "k", "v") == [("a", 1), ("b", 3)]


def test_fallback_price_was_in_force_on_some_usage_day(spark):
    """An interval that ends on the usage day counts; a later trial that no usage meets does not."""
    usage_rows = spark.createDataFrame([("o", "m", date(2024, 1, 2), 1.0)], "order_id string, meter string, usage_date date, units double")
    intervals = spark.createDataFrame(
        [("o", "m", "None", 1.0, at("01 00:00:00"), at("02 10:00:00")), ("o", "m", "Trial", 0.0, datetime(2025, 6, 1), None)],
        "order_id string, meter string, discount string, price double, start_ts timestamp_ntz, end_ts timestamp_ntz",
    )
    known = spark.createDataFrame([("o",)], "order_id string")
    got = usage.priced_usage(usage_rows, intervals, known, ntz("2026-01-01 00:00:00"), ["order_id", "meter", "usage_date"])
    assert [(r.state, r.quantity) for r in got.collect()] == [("Paid", 1.0)]


def test_sizes_of_either_case_count_a_quantity_once(spark):
    columns = "row_key string, uri string, meter string, vm_size string, quantity double, usage_date date, uri_hash string, info string, cores int, state string"
    day = date(2024, 1, 1)
    data = [("k", uri, "m", size, 1.0, day, "h", "i", 2, "Paid") for uri, size in (("A", "s1"), ("a", "s2"), (None, "s3"), ("", None))]
    rows_in = spark.createDataFrame(data, columns)
    sizes = usage.first_known_sizes(rows_in, ["row_key", "uri", "meter"], ["vm_size", "usage_date", "cores"]).withColumns(
        {"os_name": F.lit("linux"), "os_family": F.lit("linux")}
    )
    orders_in = spark.createDataFrame([("k", "S", None, "V")], "row_key string, subscription_id string, cancelled timestamp_ntz, vm_id string")
    prices = spark.createDataFrame([("s1", "linux", "s", 2, "t", 3.0)], "vm_size string, vm_type string, series string, cores int, tier string, price double")
    fact = usage.usage_fact(rows_in, usage.FactLookups(orders_in, sizes, prices)).collect()
    assert len(fact) == 4 and sum(r.quantity for r in fact) == 4.0
    assert {r.uri: r.vm_size for r in fact}[""] == "s3"


def test_the_fact_moves_usage_by_size_keys_and_by_order_only(spark, tmp_path):
    """Usage and sizes are shuffled by the size keys, usage and orders by row_key; no exchange by all columns for equal rows."""
    schema = "row_key string, uri string, meter string, vm_size string, quantity double, usage_date date, uri_hash string, info string, cores int, state string, os_name string, os_family string"
    day = date(2024, 1, 1)
    data = [("k", "A", "m", "s1", 1.0, day, "h", "i", 2, "Paid", "linux", "linux")] * 2 + [(None, "A", "m", None, 1.0, day, "h", "i", 2, "Paid", None, None)] * 2
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/usage")
    used = spark.read.parquet(f"{tmp_path}/usage")
    orders_in = spark.createDataFrame([("k", "S", None, "V")], "row_key string, subscription_id string, cancelled timestamp_ntz, vm_id string")
    prices = spark.createDataFrame([("s1", "linux", "s", 2, "t", 3.0)], "vm_size string, vm_type string, series string, cores int, tier string, price double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = usage.first_known_sizes(usage.blind_keyed(used), usage.SIZE_KEYS, ["vm_size", "usage_date", "os_name", "os_family", "cores"])
        fact = usage.usage_fact(used.drop("os_name", "os_family"), usage.FactLookups(orders_in, sizes, prices))
        moves = fact._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        got = sorted((r.row_key or "", r.subscription_id, r.vm_size, r.influenced_cost) for r in fact.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [("", None, None, None), ("k", "S", "s1", 3.0)]
    # Usage twice, sizes once, orders twice; each of the two small price lists once, and usage once to meet each.
    assert moves == 9


def test_only_intervals_of_orders_in_use_are_swept(spark, monkeypatch):
    usage_rows = spark.createDataFrame([("o", "m", date(2024, 1, 2), 1.0)], "order_id string, meter string, usage_date date, units double")
    intervals = spark.createDataFrame(
        [(order, meter, "None", 1.0, at("01 00:00:00"), None) for order, meter in (("o", "m"), ("o", "other"), ("p", "m"), (None, "m"), ("o", None))],
        "order_id string, meter string, discount string, price double, start_ts timestamp_ntz, end_ts timestamp_ntz",
    )
    swept, sweep = [], usage.interval_matches
    monkeypatch.setattr(usage, "interval_matches", lambda points, held, *more: swept.append(held.count()) or sweep(points, held, *more))
    known = spark.createDataFrame([("o",)], "order_id string")
    got = usage.priced_usage(usage_rows, intervals, known, ntz("2026-01-01 00:00:00"), ["order_id", "meter", "usage_date"])
    assert [(r.state, r.quantity) for r in got.collect()] == [("Paid", 1.0)] and swept == [1]


def test_staged_steps_are_worked_out_once(spark, tmp_path):
    from stallbook.plans import usage as u

    worked = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            worked.add(1)
            yield row

    priced = spark.createDataFrame(
        spark.createDataFrame([(1, "m", "http://A", None, 2.0)], "order_id long, meter string, uri string, tags string, quantity double").rdd.mapPartitions(seen),
        "order_id long, meter string, uri string, tags string, quantity double",
    )
    profiles = spark.createDataFrame(
        [("V1", "eu", 4, "A4", 1, 24, "d", "s", "p", BASE)],
        "vm_id string, location string, vp_count int, size string, quantity_vms int, usage_hours int, data_source string, subscription_id string, publisher_name string, ts timestamp_ntz",
    )
    steps = u.UsageSteps(priced, priced, profiles, spark.createDataFrame([("h", "S1", 2.0)], "uri_hash string, vm_size string, quantity double")).staged()
    for _ in range(2):
        stored = u.store_steps(steps, f"{tmp_path}/s", "run-1")
    assert stored.count() == 4 and worked.value == 2


def test_templates_name_multi_resource_orders(spark, rows):
    usage_rows = spark.createDataFrame(
        [("HTTP://A/1", "7", BASE), ("http://a/1", "8", BASE), ("http://b/2", "9", BASE), ("http://c/3", None, BASE)], "uri string, order_id string, start_ts timestamp_ntz"
    )
    templates = spark.createDataFrame(
        [("http://A/1", "pub2", "offer2"), ("http://a/1", "pub1", "offer1"), (None, "lost", "lost")], "template_uri string, publisher string, offer string"
    )
    got = orders.with_templates(orders.multi_resource_orders(usage_rows), templates)
    assert rows(got, "uri", "publisher_name", "offer_name") == [("http://a/1", "pub1", "offer1"), ("http://b/2", None, None)]
    assert "t_key" not in got.columns and "template_hash" not in got.columns


def test_a_repeated_run_replaces_its_steps(spark, tmp_path):
    from stallbook.plans import usage as u

    def steps(quantity):
        priced = spark.createDataFrame([(1, "m", "http://A", None, quantity)], "order_id long, meter string, uri string, tags string, quantity double")
        profiles = spark.createDataFrame(
            [("V1", "eu", 4, "A4", 1, 24, "d", "s", "p", BASE)],
            "vm_id string, location string, vp_count int, size string, quantity_vms int, usage_hours int, data_source string, subscription_id string, publisher_name string, ts timestamp_ntz",
        )
        multi = spark.createDataFrame([("h", "S1", quantity)], "uri_hash string, vm_size string, quantity double")
        return u.UsageSteps(priced, priced, profiles, multi)

    other = u.store_steps(steps(5.0), f"{tmp_path}/s", "run-0")
    u.store_steps(steps(1.0), f"{tmp_path}/s", "run-1")
    stored = u.store_steps(steps(2.0), f"{tmp_path}/s", "run-1")
    assert stored.columns == list(u.FACT_COLUMNS)
    got = sorted((r.usage_type, r.quantity, r.is_vm_usage, r.tags) for r in stored.collect())
    assert got == [("CoreOrders", 24.0, 1, ""), ("Machine", 2.0, 1, ""), ("Metered", 2.0, 0, ""), ("MultiSolution", 2.0, 0, None)]
    assert other.where("quantity = 5").count() == 3


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    from stallbook.sources.writers import write_partitioned

    data = spark.range(1000).select("id", (F.col("id") % 3).alias("day"))
    counts = {"all": F.lit(True), "some": F.col("id") < 10, "none": F.col("id") < 0}
    assert write_partitioned(data, f"{tmp_path}/w", ["day"], counts=counts) == {"all": 1000, "some": 10, "none": 0}
    assert write_partitioned(data, f"{tmp_path}/w", ["day"]) == {}
