"""Every query that SQL can state against its SQL, and which queries there are."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tidemark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
NATIVE = ["op2_exact_dedup", "op7_tool_calls", "op9_decontaminate"]


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), name, SF, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python_and_pair_nothing(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|InArrow|Cartesian|NestedLoop", plan)
