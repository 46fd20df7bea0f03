"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

from stallbook.catalog import ORACLES, QUERIES
from tests.harness import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


MANY_PARTS = [
    "w_rank_spec", "w_event_sequence", "w_price_ranks", "w_dual_row_number", "j_rank_offset", "f_interval_nudge",
    "x_order_price_timeline", "x_gov_flag_rank", "j_interval_left",
]


@pytest.mark.parametrize("name", MANY_PARTS)
def test_agrees_with_sql_when_groups_are_cut_often(spark, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


READ_BACK = ("k_", "s_")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(READ_BACK)])
def test_plan_has_no_pair_joins_and_no_python(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
