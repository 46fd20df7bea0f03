import datetime
import json

import pytest
from pyspark.sql import functions as F

from stallbook.operators import audit, projections
from stallbook.plans import offers
from stallbook.session import CHECKPOINT_DIR, scratch_path
from stallbook.sources import readers, writers
from stallbook.sources.schema import ColumnSpec, apply_types


def test_types_of_good_and_bad_text(spark):
    columns = [ColumnSpec("i", "Int"), ColumnSpec("l", "long"), ColumnSpec("d", "double"), ColumnSpec("f", "FLOAT"),
               ColumnSpec("b", "bool"), ColumnSpec("t", "date"), ColumnSpec("s", "string")]
    raw = spark.createDataFrame(
        [("1", "2", "3.5", "1.5", "true", "2024-01-02T00:00:01", "x"), ("x", "2.5", "", "-", "maybe", "soon", ""), (None,) * 7],
        "i string, l string, d string, f string, b string, t string, s string",
    )
    got = [tuple(r) for r in apply_types(raw, columns).collect()]
    assert got == [
        (1, 2, 3.5, 1.5, True, 1704153601000, "2024-01-02T00:00:01", "x"),
        (None, None, None, None, None, -1, "soon", ""),
        (None, None, None, None, None, -1, None, None),
    ]


def test_unknown_type_is_refused():
    with pytest.raises(ValueError):
        ColumnSpec("a", "money")


def test_tsv_is_positional_and_keeps_quotes(spark, rows, tmp_path):
    (tmp_path / "part.tsv").write_text('1\tsay "hi"\t2.5\n2\t\tbad\n')
    got = readers.read_tsv(spark, str(tmp_path), [ColumnSpec("id", "int"), ColumnSpec("name"), ColumnSpec("x", "double")])
    assert rows(got) == [(1, 'say "hi"', 2.5), (2, None, None)]


def test_offer_documents(spark, rows, tmp_path):
    doc = {"offers": [
        {"Id": "o1", "PublisherId": "p", "Version": "1", "NaturalIdentifier": "n", "DataServiceId": "d",
         "Languages": {"en-US": {"Title": "T", "ServicePlanDescriptions": [{"NaturalIdentifier": "sp", "RequiresExternalLicense": True}, {"Title": "x"}]}},
         "ServicePlansByMarket": {"US": [{"CurrencyCode": "USD", "NaturalIdentifier": "sp", "PricePlan": [{"Amount": 1.5, "Effect": "E"}, {"Amount": 2}]}], "DE": []},
         "VirtualMachineImagesByServicePlan": {"sp": [{"OperatingSystem": "Linux", "Version": "9"}]}},
        {"Id": "o2"},
    ]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    got = readers.read_documents(spark, str(tmp_path), "offers", offers.DOCUMENT_SCHEMA)
    assert rows(offers.latest_offers(got), "Id", "OfferType", "IsPreview") == [("o1", "VirtualMachine", None), ("o2", None, None)]
    assert rows(offers.market_prices(got), "Id", "Country", "ServicePlanNID", "PP_Amount", "PP_Effect") == [
        ("o1", "US", "sp", 1.5, "E"), ("o1", "US", "sp", 2.0, None),
    ]
    assert rows(offers.images(got), "Id", "ServicePlanName", "OperatingSystem", "Version") == [("o1", "sp", "Linux", "9")]
    assert rows(offers.offer_languages(got), "Id", "Title", "SP_ServicePlanNID", "SP_Title", "IsExternallyBilled") == [
        ("o1", "T", "", "x", 0), ("o1", "T", "sp", "", 1), ("o2", "", "", "", 0),
    ]


def test_look_back_and_missing_days(spark, rows):
    days = [datetime.date(2024, 1, d) for d in (1, 2, 4, 5, 6)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    assert rows(readers.look_back(df, "day", "2024-01-05", 3)) == [(datetime.date(2024, 1, 4),), (datetime.date(2024, 1, 5),)]
    assert rows(readers.days_without_rows(df, "day", "2024-01-05", 3)) == [(datetime.date(2024, 1, 3),)]


def test_previous_slice(spark, rows):
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2), ("20240103", 3)], "s string, v int")
    assert rows(readers.previous_slice(df, "s", F.lit("20240103")), "v") == [(2,)]
    assert rows(readers.previous_slice(df, "s", F.lit("20240101")), "v") == []


def test_partitioned_overwrite_replaces_only_its_days(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    writers.write_partitioned(first, path, ["day"])
    writers.write_partitioned(spark.createDataFrame([(3, "b")], "v int, day string"), path, ["day"])
    assert rows(spark.read.parquet(path), "v", "day") == [(1, "a"), (3, "b")]


@pytest.mark.parametrize("letter, mode", [("A", "append"), ("o", "overwrite"), ("I", "ignore"), ("E", "error"), (None, "error")])
def test_export_modes(letter, mode):
    assert writers.export_mode(letter) == mode


def test_unknown_export_mode():
    with pytest.raises(ValueError):
        writers.export_mode("X")


def test_audit_counts_documents(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "offers array<int>")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    plain = audit.slice_audit(df, "s", "20240101", "p", "r", now).first()
    nested = audit.slice_audit(df, "Offers", "20240101", "p", "r", now, documents="offers").first()
    assert (plain.record_count, nested.record_count) == (3, 2)


def test_rename_specs(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert projections.rename_by_spec(df, "a as x, b AS y").columns == ["x", "y", "c"]
    assert projections.select_by_spec(df, "b As y, a").columns == ["y", "a"]
    with pytest.raises(ValueError):
        projections.parse_renames("a to b")


def test_row_key_keeps_the_place_of_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(projections.row_key("x", "y", "z")).first()[0] == "a__c"


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, d double, at bigint")
    assert tuple(projections.fill_nulls(df, ["at"]).first()) == ("", -99999, -99999.0, -1)


class _Session:
    """Just what scratch_path reads of a session."""

    def __init__(self, master, folder):
        self.conf = {CHECKPOINT_DIR: folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_scratch_folder_follows_the_cluster_setting():
    assert scratch_path(_Session("spark://x", "hdfs://shared/"), "x").startswith("hdfs://shared/stallbook/app/x-")


def test_scratch_folder_is_machine_local_only_in_local_mode():
    assert "stallbook-app-" in scratch_path(_Session("local[2]", None), "x")
    with pytest.raises(ValueError):
        scratch_path(_Session("spark://x", None), "x")


def test_scratch_is_below_the_shared_folder_and_can_be_cleared(spark, tmp_path):
    from stallbook.session import CHECKPOINT_DIR, scratch_path, shared_folder

    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert shared_folder(spark).startswith(spark.conf.get(CHECKPOINT_DIR))


def test_a_missing_day_fails_the_load(spark):
    from stallbook.plans.usage import daily_load

    rows = spark.createDataFrame([("2024-01-01", "1"), ("2024-01-03", "1")], "d string, aggregatedts string")
    rows = rows.select(F.to_date("d").alias("usage_date"), "aggregatedts")
    with pytest.raises(ValueError, match="2024-01-02"):
        daily_load(rows, rows, "2024-01-03", 3, "run")
    assert daily_load(rows, rows, "2024-01-03", 1, "run").where("is_missing = 0").count() == 1
