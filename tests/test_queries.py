"""Every registered query against its SQL, and the shape of some plans."""

import re

import pytest

import __spark_entry__ as entry
from workload.registry import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
# whole sync cycles and streams; their plans only read what these wrote
LONG = {"sync_target", "history_append", "sync_reserved_names", "stream_sync_target", "stream_failure_latch", "stream_failure_counts", "stream_polled_sync", "sync_digest_target", "stream_history_versions"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF, QUERIES[name], SQL[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_no_python_workers_and_no_pair_joins(spark, name):
    text = plan(spark, name)
    assert not re.search(r"Python|Pandas|Cartesian", text)
    # the only nested-loop candidates would be joins without an equality
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(spark, "scan_filtered")
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in text
    assert "o_orderpriority" not in text.split("ReadSchema")[1]
    assert "text:string" not in plan(spark, "keep_latest")
    assert "ReadSchema: struct<c_nationkey:int>" in plan(spark, "report_unexpected")


def test_reports_count_before_they_join(spark):
    text = plan(spark, "report_count_by_parent")
    join, first_count = text.index("Join"), text.rindex("HashAggregate")
    assert first_count > join, "the deepest aggregate feeds the join"
