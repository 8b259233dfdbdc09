"""Profiling and comparison reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import derive, derive_sql, table
from wardmill.catalog.shaping import LINE_COLUMNS
from wardmill.operators.profile import (
    completeness,
    cost_quality,
    dataset_diff,
    describe,
    difference_histogram,
    discrepancy,
    discrepant,
    largest,
    validity_share,
)

QUERIES = {}
ORACLE = {}

GAPPY = {
    "l_orderkey": "l_orderkey",
    "l_suppkey": "CASE WHEN l_tax = 0.08 THEN NULL ELSE l_suppkey END",
    "l_quantity": "CASE WHEN l_discount = 0.1 THEN NULL ELSE l_quantity END",
    "l_returnflag": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_returnflag END",
    "l_shipdate": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END",
    "never": "CAST(NULL AS STRING)",
}
CRITICAL_COLUMNS = ("l_orderkey", "l_suppkey")


def completeness_report(spark, sf_dir):
    return completeness(derive(table(spark, sf_dir, "lineitem"), GAPPY), CRITICAL_COLUMNS)


QUERIES["completeness"] = completeness_report
ORACLE["completeness"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS "null",
        round((count(*) - count({c})) / count(*), 6) AS null_rate,
        {str(c in CRITICAL_COLUMNS).lower()} AS critical FROM ({derive_sql(GAPPY, "lineitem")})"""
    for c in GAPPY
)

ETHNIC_TEXT = """CASE WHEN p_size <= 5 THEN NULL WHEN p_size <= 10 THEN '0' WHEN p_size <= 15
    THEN '000' ELSE CAST(p_size AS STRING) END"""


def ethnic_validity(spark, sf_dir):
    parts = derive(table(spark, sf_dir, "part"), {"t": ETHNIC_TEXT})
    return validity_share(parts, ~F.col("t").isin("0", "00", "000"))


QUERIES["validity_share"] = ethnic_validity
ORACLE["validity_share"] = f"""
SELECT total, valid, total - valid AS invalid, round(100.0 * valid / total, 2) AS percent_valid
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE t NOT IN ('0', '00', '000')) AS valid
      FROM ({derive_sql({"t": ETHNIC_TEXT}, "part")}))"""

# Per order: cost components, and a stored total that is off for some numbers of lines.
COMPONENTS = ("price", "tax_part", "discount_part")
STORED_OFF = """CASE WHEN line_count = 3 THEN 2.5E0 WHEN line_count = 5 THEN -4.25E0
    WHEN line_count = 7 THEN CAST(widest AS DOUBLE) ELSE 0.25E0 END"""
_SUMMED_SQL = f"""
SELECT l_orderkey, count(*) AS line_count, max(quantity) AS widest,
       {", ".join(f"sum({c}) AS {c}" for c in COMPONENTS)}
FROM ({derive_sql(LINE_COLUMNS, "lineitem")}) GROUP BY l_orderkey"""
_ORDERS_SQL = f"""
SELECT l_orderkey, price, tax_part, discount_part,
       price + tax_part + discount_part + {STORED_OFF} AS stored FROM ({_SUMMED_SQL})"""
_DIFFERENCE_SQL = "stored - (price + tax_part + discount_part)"


def stored_totals(spark, sf_dir):
    summed = (
        derive(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("line_count"),
            F.max("quantity").alias("widest"),
            *[F.sum(c).alias(c) for c in COMPONENTS],
        )
    )
    total = F.col("price") + F.col("tax_part") + F.col("discount_part")
    return summed.select(
        "l_orderkey", *COMPONENTS, (total + F.expr(STORED_OFF)).alias("stored")
    )


def _difference():
    return discrepancy(F.col("stored"), [F.col(c) for c in COMPONENTS])


def sum_discrepancy(spark, sf_dir):
    return difference_histogram(discrepant(stored_totals(spark, sf_dir), _difference()), 25)


QUERIES["sum_discrepancy"] = sum_discrepancy
ORACLE["sum_discrepancy"] = f"""
SELECT round({_DIFFERENCE_SQL}, 2) AS difference, count(*) AS occurrences
FROM ({_ORDERS_SQL}) WHERE abs({_DIFFERENCE_SQL}) > 1
GROUP BY 1 ORDER BY occurrences DESC, difference LIMIT 25"""


def topk_largest(spark, sf_dir):
    rows = discrepant(stored_totals(spark, sf_dir), _difference())
    return largest(rows, "difference", ["l_orderkey"], 10).select(
        "l_orderkey",
        *[F.round(c, 4).alias(c) for c in ("stored", *COMPONENTS)],
        "difference",
    )


QUERIES["topk_largest"] = topk_largest
ORACLE["topk_largest"] = f"""
SELECT l_orderkey, {", ".join(f"round({c}, 4) AS {c}" for c in ("stored", *COMPONENTS))},
       round({_DIFFERENCE_SQL}, 2) AS difference
FROM ({_ORDERS_SQL}) WHERE abs({_DIFFERENCE_SQL}) > 1
ORDER BY difference DESC, l_orderkey LIMIT 10"""

COSTS = {
    "hospital": "l_extendedprice",
    "professional": "CASE WHEN l_discount > 0.08 THEN -l_extendedprice * l_tax "
    "ELSE l_extendedprice * l_tax END",
    "intensive": "CASE WHEN l_linestatus = 'O' THEN l_extendedprice * l_discount END",
    "total": "l_extendedprice + l_extendedprice * l_tax",
}


def cost_report(spark, sf_dir):
    rows = derive(table(spark, sf_dir, "lineitem"), COSTS)
    parts = [F.col(c) for c in ("hospital", "professional", "intensive")]
    return cost_quality(rows, discrepancy(F.col("total"), parts), [F.col("total"), *parts])


QUERIES["cost_quality"] = cost_report
ORACLE["cost_quality"] = f"""
SELECT *, round(100.0 * discrepant / total, 2) AS percent_discrepant,
       round(100.0 * negative / total, 2) AS percent_negative
FROM (SELECT count(*) AS total,
             count(*) FILTER (WHERE abs(total - (hospital + professional
                                                 + COALESCE(intensive, 0))) > 1) AS discrepant,
             count(*) FILTER (WHERE total < 0 OR hospital < 0 OR professional < 0
                                    OR intensive < 0) AS negative
      FROM ({derive_sql(COSTS, "lineitem")}))"""

BALANCE = {"balance": "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END"}


def describe_balance(spark, sf_dir):
    summary = describe(derive(table(spark, sf_dir, "customer"), BALANCE), "balance")
    return summary.select("statistic", F.round("value", 6).alias("value"))


_BALANCE_SQL = derive_sql(BALANCE, "customer")
_QUARTILES_SQL = " UNION ALL ".join(
    f"""SELECT '{int(q * 100)}%' AS statistic, balance AS value
    FROM (SELECT balance, row_number() OVER (ORDER BY balance) AS rn, count(*) OVER () AS n
          FROM ({_BALANCE_SQL}) WHERE balance IS NOT NULL)
    WHERE rn = CAST(floor((n - 1) * {q} + 0.5) AS BIGINT) + 1"""
    for q in (0.25, 0.5, 0.75)
)
QUERIES["describe"] = describe_balance
ORACLE["describe"] = f"""
SELECT statistic, round(value, 6) AS value FROM (
    SELECT 'count' AS statistic, CAST(count(balance) AS DOUBLE) AS value FROM ({_BALANCE_SQL})
    UNION ALL SELECT 'null_count', count(*) - count(balance) FROM ({_BALANCE_SQL})
    UNION ALL SELECT 'mean', avg(balance) FROM ({_BALANCE_SQL})
    UNION ALL SELECT 'std', stddev_samp(balance) FROM ({_BALANCE_SQL})
    UNION ALL SELECT 'min', min(balance) FROM ({_BALANCE_SQL})
    UNION ALL SELECT 'max', max(balance) FROM ({_BALANCE_SQL})
    UNION ALL {_QUARTILES_SQL})"""

# Two versions of the lines that share a key which is not unique.
VERSION_KEY = ("l_orderkey", "l_linenumber")
VERSION_1 = {
    **{k: k for k in VERSION_KEY},
    "l_partkey": "l_partkey",
    "l_quantity": "l_quantity",
    "l_returnflag": "CASE WHEN l_tax = 0.0 THEN NULL ELSE l_returnflag END",
    "l_extendedprice": "l_extendedprice",
}
VERSION_2 = {
    **VERSION_1,
    "l_quantity": "CASE WHEN l_discount = 0.05 THEN l_quantity + 1 ELSE l_quantity END",
    "l_returnflag": "CASE WHEN l_tax = 0.01 THEN NULL WHEN l_tax = 0.02 THEN 'X' "
    "ELSE l_returnflag END",
}


def version_diff(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dataset_diff(derive(lines, VERSION_1), derive(lines, VERSION_2), VERSION_KEY)


_COMPARED = [c for c in VERSION_1 if c not in VERSION_KEY]
_PAIRS_SQL = f"""
SELECT count(*) AS n, {", ".join(f"count(*) FILTER (WHERE a.{c} = b.{c}) AS {c}" for c in _COMPARED)}
FROM ({derive_sql(VERSION_1, "lineitem")}) a JOIN ({derive_sql(VERSION_2, "lineitem")}) b
  ON {" AND ".join(f"a.{k} = b.{k}" for k in VERSION_KEY)}"""
QUERIES["dataset_diff"] = version_diff
ORACLE["dataset_diff"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS DECIMAL(38,0)) AS equal,
        CAST(n - {c} AS DECIMAL(38,0)) AS different,
        round(100.0 * {c} / n, 2) AS percent_equal FROM ({_PAIRS_SQL})"""
    for c in _COMPARED
)

