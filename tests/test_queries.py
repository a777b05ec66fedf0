"""Every registered query against its oracle at the smallest scale, and what the plans must look like."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")

QUERIES, SQL = {n: q for n, q in entry.queries().items() if n in entry.CATALOG}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Streams and model fits run jobs of their own; their plans are those of the operators below.
LAZY = [n for n in sorted(QUERIES) if not n.startswith(("ev_stream", "cdc_stream", "kt_table", "ts_garch", "ts_egarch", "ts_vol"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_single_partition_gather(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            # Only a global aggregate's partial rows may meet in one task.
            assert "HashAggregate" in text or "SortAggregate" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["kt_as_of"](spark, FOLDER))
    assert "props" not in text
    text = plan(QUERIES["kt_returning"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)" in text


def test_top_n_per_group_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["ev_recent_messages"](spark, FOLDER))
    assert text.index("WindowGroupLimit") < text.rindex("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_limits_never_sort_everything(spark):
    for name in ("ts_sample", "ts_first_rows"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


def test_windows_are_partitioned_by_block(spark):
    text = plan(QUERIES["ts_rolling"](spark, FOLDER))
    assert "hashpartitioning(ticker" in text and "_block" in text


def test_rolling_reads_the_stored_series(spark):
    """Blocks and halos of one window only: the returns' own halo is not expanded again."""
    text = plan(QUERIES["ts_rolling"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") <= 4 and text.count("FileScan") <= 2


@pytest.mark.parametrize("name", ["kt_as_of", "kt_incremental", "kt_incremental_changes", "cdc_as_of"])
def test_commit_bounds_reach_the_scan(spark, name):
    scan = next(x for x in plan(QUERIES[name](spark, FOLDER)).splitlines() if "FileScan" in x)
    assert "PushedFilters" in scan and ("LessThan(ts," in scan or "GreaterThanOrEqual(ts," in scan)


def test_counting_errors_builds_no_fields(spark):
    assert "from_json" not in plan(QUERIES["ev_throughput"](spark, FOLDER))
    assert plan(QUERIES["ev_normalize"](spark, FOLDER)).count("from_json") == 1
