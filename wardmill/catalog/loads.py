"""Loads that come bit by bit, written under the scratch folder of the session."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import table
from wardmill.catalog.shaping import (
    _CARRIED,
    CONTRACTED_SQL,
    FIRST,
    LINE_COLUMNS,
    PART_SUM,
    SUMS,
    billing_lines,
    contracted_row,
)
from wardmill.operators.standing import Contraction, StandingContraction
from wardmill.session import scratch
from wardmill.sinks.snapshot import Store
from wardmill.sinks.writers import load_snapshot
from wardmill.streaming.ingest import ingest_new_files

QUERIES = {}
ORACLE = {}

LOADS = 3


def contract_standing(spark, sf_dir):
    """Billing lines contracted load by load; the states of all keys are merged each time."""
    spec = Contraction(tuple(LINE_COLUMNS), ("l_orderkey",), SUMS, ("quantity",), FIRST)
    kept = StandingContraction(spark, scratch(spark, "standing"), spec, buckets=16)
    lines = billing_lines(spark, sf_dir)
    for number in range(LOADS):
        kept.load(lines.where(F.col("l_linenumber") % LOADS == number), number)
    return contracted_row(kept.result())


QUERIES["contract_standing"] = contract_standing
ORACLE["contract_standing"] = f"""
SELECT l_orderkey, {", ".join(_CARRIED)}, {", ".join(f"round({c}, 4) AS {c}" for c in SUMS)},
       {PART_SUM} AS total, round(quantity, 6) AS mean_quantity
FROM ({CONTRACTED_SQL})"""

STREAMED = ("id", "customer", "price", "priority")


def stream_drifting(spark, sf_dir):
    """Files that hold a column as text, as integers and as doubles, taken in by two runs."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    at = scratch(spark, "drifting")
    forms = (
        [F.col("id").cast("string"), F.col("customer").cast("string"), "price", "priority"],
        ["id", F.col("customer").cast("double").alias("customer"), "priority", F.lit(1).alias("other")],
        [F.col("id").cast("double"), "customer", F.col("price").cast("string").alias("price")],
    )
    for i, form in enumerate(forms):
        orders.where(F.col("id") % 3 == i).select(*form).write.parquet(f"{at}/raw/form={i}")
        if i:
            ingest_new_files(spark, f"{at}/raw", f"{at}/out", f"{at}/checkpoint", STREAMED).awaitTermination()
    return spark.read.parquet(f"{at}/out").drop("batch")


QUERIES["stream_drifting"] = stream_drifting
ORACLE["stream_drifting"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer,
       CASE WHEN o_orderkey % 3 <> 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
       CASE WHEN o_orderkey % 3 <> 2 THEN o_orderpriority END AS priority
FROM orders"""


def refresh_versions(spark, sf_dir):
    """Two refreshes of two tables, and what readers of either version count."""
    suppliers, parts = (table(spark, sf_dir, name) for name in ("supplier", "part"))
    store = Store(spark, scratch(spark, "refresh"))
    for known in (suppliers.where("s_acctbal > 0"), suppliers):
        hospitals = known.select(
            F.col("s_suppkey").alias("CNES"), F.col("s_nationkey").cast("string").alias("NATUREZA")
        )
        codes = parts.select(F.col("p_partkey").cast("string").alias("CID"), F.col("p_name").alias("CD_DESCRICAO"))
        load_snapshot({"hospital": hospitals, "cid10": codes}, store)
    counted = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(v).cast("long").alias("version"), F.lit(name).alias("table_name"), "rows"
        )
        for v in store.versions()
        for name, df in store.tables(v).items()
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


QUERIES["refresh_versions"] = refresh_versions
ORACLE["refresh_versions"] = """
SELECT CAST(1 AS BIGINT) AS version, 'hospital' AS table_name, count(*) AS rows FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT 2, 'hospital', count(*) FROM supplier
UNION ALL SELECT unnest([1, 2]), 'cid10', n FROM (SELECT count(*) AS n FROM part)"""
