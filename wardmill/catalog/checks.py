"""Declarative checks over whole tables with derived violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import (
    LINE_KEY,
    QUANTITY,
    SHIP_DAY,
    SUPPLIER_REF,
    derive,
    derive_sql,
    sql_age,
    table,
)
from wardmill.functions.dates import completed_years
from wardmill.operators.profile import first_rows
from wardmill.operators.quality import (
    DistinctPerKeyCheck,
    RelationshipCheck,
    UniqueCheck,
    accepted_values,
    in_order,
    matches,
    non_negative,
    not_null,
    recomputed,
    scorecard,
    violations,
    within,
)
from wardmill.plans.audit import CODE_FORMAT

QUERIES = {}
ORACLE = {}
KEY_SQL = ", ".join(LINE_KEY)

# Case rows: stored values that mostly agree with what is recomputed from the dates.
CASE_COLUMNS = {
    **LINE_KEY,
    "suppkey": SUPPLIER_REF,
    "l_suppkey": "l_suppkey",
    "admitted": f"CASE WHEN l_tax = 0.07 THEN NULL ELSE {SHIP_DAY} END",
    "discharged": f"CASE WHEN l_discount = 0.0 THEN {SHIP_DAY} - 2 "
    f"WHEN l_discount = 0.01 THEN NULL ELSE {SHIP_DAY} + {QUANTITY} END",
    "born": f"{SHIP_DAY} - CAST(FLOOR(l_extendedprice / 3) AS INT)",
    "stay": f"CASE WHEN l_discount = 0.05 THEN 3 ELSE {QUANTITY} END",
    "sex": "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 3 "
    "WHEN l_tax = 0.01 THEN NULL ELSE 9 END",
    "code": "CASE WHEN l_tax = 0.02 THEN NULL WHEN l_tax = 0.03 THEN '0' "
    "WHEN l_tax = 0.04 THEN l_returnflag || '1' ELSE l_returnflag || "
    f"LPAD(CAST({QUANTITY} AS STRING), 2, '0') || CASE WHEN l_tax = 0.05 THEN '.7' ELSE '' END END",
    "ethnicity": f"{QUANTITY} * 8 - 8",
    "amount": "CASE WHEN l_discount = 0.1 THEN -l_extendedprice ELSE l_extendedprice END",
}
CASES_SQL = derive_sql(CASE_COLUMNS, "lineitem")


def cases(spark, sf_dir):
    return derive(table(spark, sf_dir, "lineitem"), CASE_COLUMNS)


def _failing(spark, sf_dir, check, *columns):
    return violations({"cases": cases(spark, sf_dir)}, check).select(*columns)


def _add(name, check, columns, condition):
    """Register one row check with the SQL condition it stands for."""
    QUERIES[name] = lambda spark, sf_dir: _failing(spark, sf_dir, check(), *LINE_KEY, *columns)
    ORACLE[name] = (
        f"SELECT {', '.join([*LINE_KEY, *columns])} FROM ({CASES_SQL}) WHERE {condition}"
    )


_add("check_not_null", lambda: not_null("cases", "admitted"), ("admitted",), "admitted IS NULL")
_add(
    "check_accepted",
    lambda: accepted_values("cases", "sex", (1, 3)),
    ("sex",),
    "sex IS NOT NULL AND sex NOT IN (1, 3)",
)
_add(
    "check_regex",
    lambda: matches("cases", "code", CODE_FORMAT),
    ("code",),
    f"code IS NOT NULL AND NOT regexp_matches(code, '{CODE_FORMAT}')",
)
_add(
    "check_date_order",
    lambda: in_order("cases", "admitted", "discharged"),
    ("admitted", "discharged"),
    "discharged < admitted",
)
_add(
    "check_range",
    lambda: within("cases", "ethnicity", 0, 270),
    ("ethnicity",),
    "ethnicity <= 0 OR ethnicity > 270",
)
_add(
    "check_non_negative",
    lambda: non_negative("cases", ("amount", "stay")),
    ("amount", "stay"),
    "amount < 0 OR stay < 0",
)


def check_unique(spark, sf_dir):
    lines = {"lineitem": table(spark, sf_dir, "lineitem")}
    return violations(lines, UniqueCheck("lineitem", ("l_orderkey", "l_linenumber")))


QUERIES["check_unique"] = check_unique
ORACLE["check_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


def _with_ages(frame):
    stored = completed_years(F.col("admitted"), F.col("born"))
    off = F.when(F.col("l_linenumber") == 4, 1).otherwise(0)
    return frame.select("*", (stored + off).alias("age"))


AGE_SQL = sql_age("admitted", "born")
AGES_SQL = (
    f"SELECT *, {AGE_SQL} + CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END AS age FROM ({CASES_SQL})"
)


def recompute_mismatch(spark, sf_dir):
    frame = _with_ages(cases(spark, sf_dir))
    computed_stay = F.date_diff("discharged", "admitted")
    computed_age = completed_years(F.col("admitted"), F.col("born"))
    stay = recomputed("cases", "stay", computed_stay)
    age = recomputed("cases", "age", computed_age, applies=F.col("admitted") > F.col("born"))
    return frame.where(stay.violates | age.violates).select(
        *LINE_KEY,
        "stay",
        computed_stay.alias("computed_stay"),
        (F.col("stay") - computed_stay).alias("difference"),
        "age",
        computed_age.alias("computed_age"),
    )


QUERIES["recompute_mismatch"] = recompute_mismatch
ORACLE["recompute_mismatch"] = f"""
SELECT {KEY_SQL}, stay, computed_stay, stay - computed_stay AS difference, age, computed_age
FROM (SELECT *, CAST(date_diff('day', admitted, discharged) AS INTEGER) AS computed_stay,
             {AGE_SQL} AS computed_age FROM ({AGES_SQL}))
WHERE stay <> computed_stay OR (admitted > born AND age <> computed_age)"""


def sample_mismatch(spark, sf_dir):
    """The first 20 rows whose stored stay is off, in key order."""
    frame = recompute_mismatch(spark, sf_dir).where(F.col("difference") != 0)
    return first_rows(frame, [*LINE_KEY, "stay", "computed_stay"], 20).select(
        *LINE_KEY, "stay", "computed_stay", "difference"
    )


QUERIES["sample_mismatch"] = sample_mismatch
ORACLE["sample_mismatch"] = f"""
SELECT {KEY_SQL}, stay, computed_stay, stay - computed_stay AS difference
FROM (SELECT *, CAST(date_diff('day', admitted, discharged) AS INTEGER) AS computed_stay
      FROM ({CASES_SQL}))
WHERE stay <> computed_stay ORDER BY {KEY_SQL}, stay, computed_stay LIMIT 20"""


def quality_scorecard(spark, sf_dir):
    tables = {
        "cases": _with_ages(cases(spark, sf_dir)),
        "orders": table(spark, sf_dir, "orders"),
        "supplier": table(spark, sf_dir, "supplier"),
    }
    admitted, born = F.col("admitted"), F.col("born")
    checks = [
        not_null("cases", "admitted"),
        not_null("cases", "sex"),
        not_null("orders", "o_custkey"),
        accepted_values("cases", "sex", (1, 3)),
        accepted_values("orders", "o_orderstatus", ("F", "O")),
        matches("cases", "code", CODE_FORMAT),
        in_order("cases", "admitted", "discharged"),
        within("cases", "ethnicity", 0, 270),
        non_negative("cases", ("amount",)),
        recomputed("cases", "stay", F.date_diff("discharged", "admitted")),
        recomputed("cases", "age", completed_years(admitted, born), applies=admitted > born),
        UniqueCheck("orders", ("o_orderkey",)),
        UniqueCheck("cases", ("l_orderkey", "l_linenumber")),
        RelationshipCheck("cases", ("suppkey",), "supplier", ("s_suppkey",)),
        RelationshipCheck("cases", ("l_orderkey",), "orders", ("o_orderkey",)),
        DistinctPerKeyCheck("orders", "o_custkey", "o_orderpriority", 4),
    ]
    return scorecard(tables, checks)


_SCORES = (
    ("not_null", "cases", "admitted", "admitted IS NULL"),
    ("not_null", "cases", "sex", "sex IS NULL"),
    ("not_null", "orders", "o_custkey", "o_custkey IS NULL"),
    ("accepted_values", "cases", "sex", "sex NOT IN (1, 3)"),
    ("accepted_values", "orders", "o_orderstatus", "o_orderstatus NOT IN ('F', 'O')"),
    ("format", "cases", "code", f"NOT regexp_matches(code, '{CODE_FORMAT}')"),
    ("date_order", "cases", "admitted..discharged", "discharged < admitted"),
    ("range", "cases", "ethnicity", "ethnicity <= 0 OR ethnicity > 270"),
    ("non_negative", "cases", "amount", "amount < 0"),
    ("recompute", "cases", "stay", "stay <> date_diff('day', admitted, discharged)"),
    ("recompute", "cases", "age", f"admitted > born AND age <> {AGE_SQL}"),
    (
        "relationships",
        "cases",
        "suppkey",
        "suppkey IS NOT NULL AND suppkey NOT IN (SELECT s_suppkey FROM supplier)",
    ),
    (
        "relationships",
        "cases",
        "l_orderkey",
        "l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    ),
)
_GROUP_SCORES = (
    ("unique", "orders", "o_orderkey", "o_orderkey", "count(*) > 1"),
    ("unique", "cases", "l_orderkey+l_linenumber", "l_orderkey, l_linenumber", "count(*) > 1"),
    (
        "distinct_per_key",
        "orders",
        "o_orderpriority",
        "o_custkey",
        "count(DISTINCT o_orderpriority) > 4",
    ),
)


def _source(name: str) -> str:
    return f"({AGES_SQL})" if name == "cases" else name


def _score_sql(name: str, source: str, column: str, counted: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{source}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS violations, count(*) = 0 AS passed FROM {counted}"
    )


QUERIES["quality_scorecard"] = quality_scorecard
_SCORES_SQL = " UNION ALL ".join(
    [_score_sql(n, s, c, f"{_source(s)} x WHERE {cond}") for n, s, c, cond in _SCORES]
    + [
        _score_sql(n, s, c, f"(SELECT {k} FROM {_source(s)} x GROUP BY {k} HAVING {h})")
        for n, s, c, k, h in _GROUP_SCORES
    ]
)
ORACLE["quality_scorecard"] = f"SELECT *, CAST(NULL AS VARCHAR) AS reason FROM ({_SCORES_SQL})"
