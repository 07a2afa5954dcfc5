"""All registered queries against their SQL, and what their plans must look like."""

import pytest

import __spark_entry__ as registered
from tests.oracle_check import compare, connect
from tests.plans import plan_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_names_and_entry(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert registered.entry(spark).count() > 0


def test_scans_read_needed_columns_only(spark):
    plan = plan_of(QUERIES["q_hourly_features"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["q_dropna"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(value)]" in plan


def test_row_wise_queries_do_not_shuffle(spark):
    for name in ("q_epoch_to_hour", "q_status_label", "q_date_parts", "q_extract_numbers", "q_split_ids",
                 "q_parse_requests", "q_standardize", "q_impute_median", "q_impute_mode", "q_stratified_split"):
        assert "Exchange hashpartitioning" not in plan_of(QUERIES[name](spark, FOLDER)), name
