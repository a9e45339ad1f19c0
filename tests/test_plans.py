"""The plans: what reaches the scan, what is reduced before a shuffle, how often data is shuffled."""

import pytest

from tests.compare import explained
from tidemark.plans.catalog import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """Plans without broadcasts, as between two large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: explained(queries()[name](spark, FOLDER))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("d16_incremental_extract", "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)"),
        ("d16_incremental_strict", "GreaterThan(o_orderdate,1998-01-01T00:00)"),
        ("d17_range_extract", "LessThanOrEqual(o_orderdate,1997-02-28T00:00)"),
        ("p8_filters", "EqualTo(l_returnflag,R)"),
        ("p13_last_days", "GreaterThanOrEqual(ts,2024-01-23T00:00)"),
    ],
)
def test_filters_reach_the_scan(plan, name, pushed):
    assert pushed in plan(name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("a2_sum_by_code", "struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>"),
        ("d23_missing_snapshots", "struct<o_orderstatus:string,o_orderdate:timestamp_ntz>"),
        ("j10_pre_aggregated", "struct<l_orderkey:bigint,l_quantity:double>"),
        ("s5_parquet_projected", "struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"),
    ],
)
def test_only_needed_columns_are_read(plan, name, columns):
    assert f"ReadSchema: {columns}" in plan(name)


@pytest.mark.parametrize(
    "name", ["w1_dedup_kept", "w6_earliest_version", "a7_distinct_on", "v4_as_of_version", "v7_vacuum", "l11_match_signature"]
)
def test_first_rows_are_picked_before_the_shuffle(plan, name):
    tree = plan(name).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize(
    "name, exchanges",
    [("d3_scd2_merge", 2), ("d1_scd1", 2), ("d8_update_from_join", 2), ("v6_restore", 3), ("d22_apply_status", 3), ("l7_sql_references", 0)],
)
def test_shuffles_are_few(plan, name, exchanges):
    tree = plan(name).split("\n\n")[0]
    assert tree.count("Exchange") <= exchanges
