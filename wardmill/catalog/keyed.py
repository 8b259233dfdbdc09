"""Key operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import SUPPLIER_REF, derive, derive_sql, table
from wardmill.operators.keys import (
    keep_children,
    missing_values,
    new_keys,
    orphan_frequency,
    orphan_keys,
)
from wardmill.operators.quality import RelationshipCheck, keys_with_many, scorecard
from wardmill.sources.manifest import coverage_gaps, expected_grid

QUERIES = {}
ORACLE = {}


def incremental_new_keys(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), "o_orderstatus"
    )
    present = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_linestatus") == "F")
        .select(F.col("l_orderkey").alias("key"))
    )
    return new_keys(listed, present, "key")


QUERIES["incremental_new_keys"] = incremental_new_keys
ORACLE["incremental_new_keys"] = """
SELECT o_orderkey AS key, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')"""


def period_grid_gaps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    present = orders.select("o_custkey", F.year("o_orderdate").alias("year"))
    first, last = present.agg(F.min("year"), F.max("year")).first()
    grid = expected_grid(orders.select("o_custkey").distinct(), first, last)
    return coverage_gaps(grid, present, ("o_custkey", "year"))


QUERIES["period_grid_gaps"] = period_grid_gaps
ORACLE["period_grid_gaps"] = """
SELECT c.o_custkey, CAST(y.year AS INTEGER) AS year
FROM (SELECT DISTINCT o_custkey FROM orders) c,
     (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS year
      FROM orders) y
WHERE NOT EXISTS (SELECT 1 FROM orders o
                  WHERE o.o_custkey = c.o_custkey AND year(o.o_orderdate) = y.year)"""

REFS = {"l_orderkey": "l_orderkey", "suppkey": SUPPLIER_REF}
_REFS_SQL = derive_sql(REFS, "lineitem")


def _references(spark, sf_dir):
    return derive(table(spark, sf_dir, "lineitem"), REFS)


def orphan_supplier_keys(spark, sf_dir):
    return orphan_keys(
        _references(spark, sf_dir), "suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"
    )


QUERIES["orphan_keys"] = orphan_supplier_keys
ORACLE["orphan_keys"] = f"""
SELECT DISTINCT suppkey FROM ({_REFS_SQL})
WHERE suppkey IS NOT NULL AND suppkey NOT IN (SELECT s_suppkey FROM supplier)"""


def orphan_supplier_frequency(spark, sf_dir):
    return orphan_frequency(
        _references(spark, sf_dir),
        "suppkey",
        table(spark, sf_dir, "supplier"),
        "s_suppkey",
        20,
        "occurrences",
    )


QUERIES["orphan_frequency"] = orphan_supplier_frequency
ORACLE["orphan_frequency"] = f"""
SELECT suppkey, count(*) AS occurrences FROM ({_REFS_SQL})
WHERE suppkey IS NOT NULL AND suppkey NOT IN (SELECT s_suppkey FROM supplier)
GROUP BY suppkey ORDER BY occurrences DESC, suppkey LIMIT 20"""

# (child, column, parent, key) of the given tables.
FOREIGN_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)
# Parents of the cleanup; the orders of the other customers go.
CUSTOMERS = "c_acctbal >= 0"
# Urgent orders name a customer that does not exist.
CUSTOMER_REF = "CASE WHEN o_orderpriority = '1-URGENT' THEN -o_custkey ELSE o_custkey END"


def _linked_tables(spark, sf_dir):
    names = {name for fk in FOREIGN_KEYS for name in (fk[0], fk[2])}
    tables = {name: table(spark, sf_dir, name) for name in names}
    tables["orders"] = tables["orders"].select("*", F.expr(CUSTOMER_REF).alias("custkey"))
    tables["lineitem"] = tables["lineitem"].select("*", F.expr(SUPPLIER_REF).alias("suppkey"))
    return tables


def fk_audit(spark, sf_dir):
    checks = [RelationshipCheck(c, (col,), p, (pk,)) for c, col, p, pk in FOREIGN_KEYS]
    scored = scorecard(_linked_tables(spark, sf_dir), checks)
    return scored.select("table_name", "column_name", "violations", "passed")


def _linked_sql(name: str) -> str:
    if name == "orders":
        return f"(SELECT *, {CUSTOMER_REF} AS custkey FROM orders)"
    if name == "lineitem":
        return f"(SELECT *, {SUPPLIER_REF} AS suppkey FROM lineitem)"
    return name


QUERIES["fk_audit"] = fk_audit
ORACLE["fk_audit"] = " UNION ALL ".join(
    f"SELECT '{c}' AS table_name, '{col}' AS column_name, count(*) AS violations, "
    f"count(*) = 0 AS passed FROM {_linked_sql(c)} x WHERE x.{col} IS NOT NULL "
    f"AND x.{col} NOT IN (SELECT {pk} FROM {_linked_sql(p)} y)"
    for c, col, p, pk in FOREIGN_KEYS
)


def set_difference(spark, sf_dir):
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    active = table(spark, sf_dir, "events").select(F.col("user_id").alias("custkey"))
    return missing_values(buyers, active)


QUERIES["set_difference"] = set_difference
ORACLE["set_difference"] = """
SELECT o_custkey AS custkey FROM orders EXCEPT SELECT user_id FROM events"""


def referential_cleanup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").where(CUSTOMERS)
    orders = keep_children(table(spark, sf_dir, "orders"), "o_custkey", customers, "c_custkey")
    lines = keep_children(table(spark, sf_dir, "lineitem"), "l_orderkey", orders, "o_orderkey")
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


QUERIES["referential_cleanup"] = referential_cleanup
ORACLE["referential_cleanup"] = f"""
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                     WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {CUSTOMERS}))"""


def having_distinct(spark, sf_dir):
    return keys_with_many(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", 4)


QUERIES["having_distinct"] = having_distinct
ORACLE["having_distinct"] = """
SELECT o_custkey, count(DISTINCT o_orderpriority) AS distinct_values FROM orders
GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 4"""
