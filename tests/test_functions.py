import datetime

import pytest
from pyspark.sql import functions as F

from stallbook.functions import nested, states, text, times


def one(spark, column, **values):
    """Evaluate a column over one row of typed literals."""
    df = spark.range(1).select(*[v.alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return df.select(column.alias("r")).first()["r"]


def s(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "value, want",
    [
        ("offer", "offer"), ("offer-646", "offer"), ("offer-preview", "offer"), ("-preview-x", ""),
        ("a-646-preview", "a"), ("a-preview-646", "a"), (None, None),
    ],
)
def test_cut_at_marker(spark, value, want):
    assert one(spark, text.cut_at_marker(F.col("c")), c=s(value)) == want


@pytest.mark.parametrize(
    "value, want",
    [("a__b", "b"), ("a_b", "a_b"), ("a__", None), ("", None), ("__x", "x"), ("a__b__c", "b__c"), (None, None)],
)
def test_after_separator(spark, value, want):
    assert one(spark, text.after_separator(F.col("c")), c=s(value)) == want


@pytest.mark.parametrize(
    "value, want",
    [("SharedCore", 0.1666), ("16core", 16.0), ("2Core", 2.0), ("core", None), ("storage", None), (None, None)],
)
def test_core_count(spark, value, want):
    assert one(spark, text.core_count(F.col("c")), c=s(value)) == want


@pytest.mark.parametrize("value, want", [(4, "4core"), (0, None), (None, None)])
def test_core_meter(spark, value, want):
    assert one(spark, text.core_meter(F.col("c")), c=F.lit(value).cast("double")) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ('{"ServiceType": "Standard_A1", "x": "y"}', "Standard_A1"), ('{"servicetype":"B"}', "B"), ('{"other": "B"}', None),
        ('{"ServiceType": ""}', None), (None, None),
    ],
)
def test_quoted_field(spark, value, want):
    assert one(spark, text.quoted_field(F.col("c")), c=s(value)) == want


@pytest.mark.parametrize("value, want", [(" true ", 1), ("1", 1), ("TRUE", 1), ("yes", 0), ("", 0), (None, 0)])
def test_flag_text(spark, value, want):
    assert one(spark, text.flag_text(F.col("c")), c=s(value)) == want


@pytest.mark.parametrize("value, want", [("abcdef", "def"), ("abc", "abc"), ("", ""), (None, None)])
def test_right_part(spark, value, want):
    assert one(spark, text.right_part(F.col("c"), 3), c=s(value)) == want


def test_like_needs_a_real_underscore(spark):
    pattern = "%windows\\_oracle%"
    assert one(spark, text.like_any_case(F.col("c"), pattern), c=s("My_Windows_Oracle_12")) is True
    assert one(spark, text.like_any_case(F.col("c"), pattern), c=s("windows-oracle")) is False
    assert one(spark, text.like_any_case(F.col("c"), pattern), c=s(None)) is False


def test_first_rule_of_a_classification_wins(spark):
    rules = [("classiccompute", "RDFE"), ("compute", "CRP")]
    assert one(spark, text.classify_text(F.col("c"), rules, "Unknown"), c=s("x.ClassicCompute/y")) == "RDFE"
    assert one(spark, text.classify_text(F.col("c"), rules, "Unknown"), c=s("x.Compute/y")) == "CRP"
    assert one(spark, text.classify_text(F.col("c"), rules, "Unknown"), c=s(None)) == "Unknown"


def test_clean_join(spark):
    words = F.array(F.lit(" a "), F.lit(""), F.lit("  "), F.lit("b"))
    assert one(spark, nested.clean_join(F.col("c")), c=words) == "a|b"
    assert one(spark, nested.clean_join(F.col("c")), c=F.array(F.lit(" "))) is None
    assert one(spark, nested.clean_join(F.col("c")), c=F.lit(None).cast("array<string>")) is None


ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}"


@pytest.mark.parametrize(
    "value, extract, pattern, want",
    [
        ("2024-01-02 03:04:05", None, "yyyy-MM-dd HH:mm:ss", 1704164645000),
        ("2024-01-02T03:04:05", None, "yyyy-MM-dd HH:mm:ss", 1704164645000),
        ("at 2024-01-02T03:04:05.678Z", ISO, "yyyy-MM-dd HH:mm:ss.SSS", 1704164645678),
        ("no date", ISO, "yyyy-MM-dd HH:mm:ss.SSS", -1),
        ("2024-13-45 99:00:00", None, "yyyy-MM-dd HH:mm:ss", -1),
        ("", None, "yyyy-MM-dd HH:mm:ss", -1), (None, None, "yyyy-MM-dd HH:mm:ss", -1),
    ],
)
def test_parse_millis(spark, value, extract, pattern, want):
    assert one(spark, times.parse_millis(F.col("c"), extract, pattern), c=s(value)) == want


@pytest.mark.parametrize("value, want", [(1704164645678, "2024-01-02 03:04:05.678"), (-1, ""), (None, "")])
def test_format_millis(spark, value, want):
    assert one(spark, times.format_millis(F.col("c")), c=F.lit(value).cast("bigint")) == want


def ts(value):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "at, previous, want",
    [
        ("2024-01-01 23:59:59", None, "2024-01-02 00:00:00"), ("2024-01-01 10:00:00", None, "2024-01-01 10:00:00"),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:02"),
        ("2024-01-01 10:00:01", "2024-01-01 10:00:00", "2024-01-01 10:00:03"),
        ("2024-01-01 10:00:02", "2024-01-01 10:00:00", "2024-01-01 10:00:02"),
    ],
)
def test_interval_start(spark, at, previous, want):
    got = one(spark, times.interval_start(F.col("a"), F.col("p")), a=ts(at), p=ts(previous))
    assert got == datetime.datetime.fromisoformat(want)


@pytest.mark.parametrize(
    "at, following, end, want",
    [
        ("2024-01-01 10:00:00", None, None, None), ("2024-01-01 10:00:00", None, "2024-02-01 00:00:00", "2024-02-01 00:00:00"),
        ("2024-01-01 10:00:00", "2024-01-05 23:59:59", None, "2024-01-05 23:59:59"),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:00", None, "2024-01-01 10:00:01"),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:01", None, "2024-01-01 10:00:02"),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:09", None, "2024-01-01 10:00:08"),
    ],
)
def test_interval_end(spark, at, following, end, want):
    got = one(spark, times.interval_end(F.col("a"), F.col("n"), F.col("e")), a=ts(at), n=ts(following), e=ts(end))
    assert got == (None if want is None else datetime.datetime.fromisoformat(want))


def test_after_cancel(spark):
    day, cancelled = F.col("d"), F.col("c")
    flag = times.after_cancel(day, cancelled)
    assert one(spark, flag, d=ts("2024-01-02 00:00:00"), c=ts("2024-01-01 23:00:00")) == 1
    assert one(spark, flag, d=ts("2024-01-01 23:30:00"), c=ts("2024-01-01 23:00:00")) == 0
    assert one(spark, flag, d=ts("2024-01-02 00:00:00"), c=ts(None)) == 0


@pytest.mark.parametrize(
    "found, discount, price, known, want",
    [
        (True, "None", 0.0, True, "Free"), (True, "none", 0.4, True, "Paid"), (True, "Trial", 5.0, True, "Trial"),
        (True, "None", None, True, "None"), (True, "None", None, False, "None"),
        (False, None, None, True, "OrderAPI Missing Price"), (False, None, None, False, "OrderAPI Missing Order"),
        (True, None, 5.0, True, "OrderAPI Missing Price"),
    ],
)
def test_price_state(spark, found, discount, price, known, want):
    column = states.price_state(F.col("f"), F.col("d"), F.col("p"), F.col("k"))
    got = one(spark, column, f=F.lit(found), d=s(discount), p=F.lit(price).cast("double"), k=F.lit(known))
    assert got == want


@pytest.mark.parametrize(
    "licence, outside, price, market, billing, payment",
    [
        (True, None, 5.0, 5.0, "Free", "Unknown"), (None, True, 5.0, 5.0, "Free", "BYOL"),
        (None, False, 0.0, 5.0, "Free", "Billed"), (False, True, 3.0, 0.0, "Paid", "Billed"),
        (False, True, None, 0.0, "Free", "Billed"), (None, None, None, 2.0, "Paid", "Billed"),
        (False, False, None, None, "Unknown", "Billed"), (True, True, None, 1.0, "Free", "Unknown"),
    ],
)
def test_billing_and_payment(spark, licence, outside, price, market, billing, payment):
    values = {
        "l": F.lit(licence).cast("boolean"), "o": F.lit(outside).cast("boolean"),
        "p": F.lit(price).cast("double"), "m": F.lit(market).cast("double"),
    }
    assert one(spark, states.billing_type(F.col("l"), F.col("o"), F.col("p"), F.col("m")), **values) == billing
    assert one(spark, states.payment_type(F.col("l"), F.col("o")), **values) == payment


@pytest.mark.parametrize(
    "subscription, enterprise, channel, want",
    [
        (None, True, "Direct Enterprise", "PAYG"), ("s", True, None, "Direct Enterprise"),
        ("s", True, "Indirect Enterprise", "Indirect Enterprise"), ("s", False, "Direct Enterprise", "Direct Enterprise"),
        ("s", False, None, "PAYG"), ("s", None, None, "PAYG"),
    ],
)
def test_licence_type(spark, subscription, enterprise, channel, want):
    column = states.licence_type(F.col("s"), F.col("e"), F.col("c"))
    assert one(spark, column, s=s(subscription), e=F.lit(enterprise).cast("boolean"), c=s(channel)) == want
