"""The registered queries of the corpus operators against their SQL."""

from __future__ import annotations

import pytest
from oracle import DATA, compare, connect

import corpus_pipeline
from wardmill.llm.queries import ORACLE, QUERIES

SF_DIR = DATA / "sf0.001"
NATIVE = ("op3_line_dedup", "op4_fingerprint", "op6_decontaminate")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) == []


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_reruns_agree(spark, name):
    first, second = (sorted(map(str, QUERIES[name](spark, str(SF_DIR)).collect())) for _ in "ab")
    assert first and first == second


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert node not in plan


def test_pipeline_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = spark.createDataFrame(function(spark, docs, str(SF_DIR)).collect(), docs.schema)
        assert docs.columns == columns, name
        after = [r.doc_id for r in docs.collect()]
        assert set(after) <= before and len(after) == len(set(after)) and after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF_DIR)).collect()
    assert sorted(r.doc_id for r in last) == sorted(after)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, str(SF_DIR)).collect()))
    assert whole == sorted(map(tuple, last))
