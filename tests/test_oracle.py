"""Every registered query against its SQL, and what no plan may contain."""

from __future__ import annotations

import pytest
from oracle import DATA, compare, connect

from __spark_entry__ import entry
from wardmill.catalog import all_oracles as oracle_sql
from wardmill.catalog import all_queries as queries

SF_DIR = DATA / "sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# Query families that share one plan shape are covered by one member.
SLOW_TWINS = [n for n in queries() if n.startswith("star_") and n != "star_hospital"]


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, duck, name):
    problems = compare(spark, duck, SF_DIR, queries()[name], oracle_sql()[name])
    if problems == ["empty result"]:
        problems = []  # possible at this scale only
    assert problems == []


@pytest.mark.parametrize("name", [n for n in queries() if n not in SLOW_TWINS])
def test_plan_has_no_forbidden_node(spark, name):
    plan = queries()[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan


def test_entry(spark):
    assert entry(spark).count() > 0


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.splitlines())


def test_contraction_shuffles_once(spark):
    assert exchanges(queries()["contract"](spark, str(SF_DIR))) == 1


@pytest.mark.parametrize("name", ["dedup_first", "check_unique", "top_values"])
def test_one_shuffle(spark, name):
    assert exchanges(queries()[name](spark, str(SF_DIR))) == 1


@pytest.mark.parametrize(
    "name", ["check_not_null", "filter_isin_extract", "unpivot_codes", "parse_dates"]
)
def test_no_shuffle(spark, name):
    plan = queries()[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = queries()["having_distinct"](spark, str(SF_DIR))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in plan
    plan = queries()["filter_isin_extract"](spark, str(SF_DIR))._jdf.queryExecution().toString()
    assert "In(l_returnflag, [A,R])" in plan
