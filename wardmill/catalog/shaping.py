"""Contraction, extraction, reshaping and schema work over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.catalog.common import QUANTITY, SHIP_DAY, derive, derive_sql, table
from wardmill.functions import narrow
from wardmill.operators.contract import contract, dedup_first
from wardmill.operators.extract import Satellite, extract, mode_dimension, unpivot_codes
from wardmill.operators.keys import number_rows
from wardmill.operators.profile import top_values
from wardmill.operators.project import conform, union_as_text
from wardmill.sinks.writers import table_rows, with_total

QUERIES = {}
ORACLE = {}

# Billing lines with their cost components, and the order that makes "first" well defined.
LINE_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "shipped": SHIP_DAY,
    "quantity": QUANTITY,
    "l_returnflag": "CASE WHEN l_tax = 0.08 THEN NULL ELSE l_returnflag END",
    "l_linestatus": "l_linestatus",
    "price": "l_extendedprice",
    "tax_part": "l_extendedprice * l_tax",
    "discount_part": "CASE WHEN l_linestatus = 'O' THEN l_extendedprice * l_discount ELSE 0.0 END",
    "l_discount": "l_discount",
}
FIRST = ("l_linenumber", "l_partkey", "l_suppkey", "shipped")
SUMS = ("price", "tax_part", "discount_part")
PART_SUM = "round(price + tax_part + discount_part, 4)"


def billing_lines(spark, sf_dir):
    return derive(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)


def contracted_lines(spark, sf_dir):
    return contract(
        billing_lines(spark, sf_dir),
        key=("l_orderkey",),
        sums=SUMS,
        means=("quantity",),
        order=FIRST,
    )


_LINES_SQL = derive_sql(LINE_COLUMNS, "lineitem")
_CARRIED = [c for c in LINE_COLUMNS if c not in ("l_orderkey", "quantity", *SUMS)]
_TIES = [c for c in _CARRIED if c not in FIRST]
_RANK_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in (*FIRST, *_TIES))
CONTRACTED_SQL = f"""
SELECT t.l_orderkey, {", ".join(f"f.{c}" for c in _CARRIED)}, t.quantity,
       {", ".join(f"t.{c}" for c in SUMS)}
FROM (SELECT l_orderkey, avg(quantity) AS quantity,
             {", ".join(f"sum({c}) AS {c}" for c in SUMS)}
      FROM ({_LINES_SQL}) GROUP BY l_orderkey) t
JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_RANK_ORDER}) AS rn
      FROM ({_LINES_SQL})) f
  ON t.l_orderkey = f.l_orderkey AND f.rn = 1"""


def contracted_row(contracted):
    rounded = [F.round(c, 4).alias(c) for c in SUMS]
    total = F.round(sum([F.col(c) for c in SUMS[1:]], F.col(SUMS[0])), 4)
    return contracted.select(
        "l_orderkey",
        *_CARRIED,
        *rounded,
        total.alias("total"),
        F.round("quantity", 6).alias("mean_quantity"),
    )


def contract_query(spark, sf_dir):
    return contracted_row(contracted_lines(spark, sf_dir))


QUERIES["contract"] = contract_query
ORACLE["contract"] = f"""
SELECT l_orderkey, {", ".join(_CARRIED)}, {", ".join(f"round({c}, 4) AS {c}" for c in SUMS)},
       {PART_SUM} AS total, round(quantity, 6) AS mean_quantity
FROM ({CONTRACTED_SQL})"""

UNION_COLUMNS = ("account", "name", "nation", "balance", "segment")


def union_missing_cols(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("account"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("double").cast("bigint").alias("nation"),
        F.lit("x").alias("not_wanted"),
    )
    return union_as_text([customers, suppliers], UNION_COLUMNS)


QUERIES["union_missing_cols"] = union_missing_cols
ORACLE["union_missing_cols"] = """
SELECT CAST(c_custkey AS VARCHAR) AS account, c_name AS name,
       CAST(c_nationkey AS VARCHAR) AS nation,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL, NULL
FROM supplier"""

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.IntegerType()),
        T.StructField("o_custkey", T.ByteType()),
        T.StructField("o_totalprice", T.IntegerType()),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_orderpriority", T.ShortType()),
        T.StructField("o_clerk", T.StringType()),
    ]
)


def conform_schema(spark, sf_dir):
    return conform(table(spark, sf_dir, "orders"), ORDER_SCHEMA, fill_missing=True)


QUERIES["conform_schema"] = conform_schema
ORACLE["conform_schema"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, TRY_CAST(o_custkey AS TINYINT) AS o_custkey,
       CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN regexp_full_match(o_orderpriority, '[0-9]+')
            THEN TRY_CAST(o_orderpriority AS SMALLINT) END AS o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_clerk
FROM orders"""

FACT_SQL = """
SELECT l_suppkey, l_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS ordered,
       CAST(l_shipdate AS DATE) AS shipped, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, o_orderstatus, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def project_fact(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_suppkey",
        "l_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "o_orderstatus",
        "o_orderpriority",
    )


QUERIES["project_fact"] = project_fact
ORACLE["project_fact"] = FACT_SQL

NUMBERED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


def surrogate_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*NUMBERED)
    return number_rows(lines, "row_id", order=NUMBERED, total=True)  # rows are whole


QUERIES["surrogate_key"] = surrogate_key
ORACLE["surrogate_key"] = f"""
SELECT row_number() OVER (ORDER BY {", ".join(NUMBERED)}) AS row_id, {", ".join(NUMBERED)}
FROM lineitem"""

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_row_counts(spark, sf_dir):
    return with_total(table_rows({name: table(spark, sf_dir, name) for name in COUNTED}))


_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}" for name in COUNTED
)
QUERIES["table_row_counts"] = table_row_counts
ORACLE["table_row_counts"] = f"""
SELECT * FROM ({_COUNTS_SQL})
UNION ALL SELECT 'total', CAST(sum(rows) AS BIGINT) FROM ({_COUNTS_SQL})"""


def exact_group_count(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("rows"))
    return with_total(counts.withColumnRenamed("event_type", "table_name"))


QUERIES["exact_group_count"] = exact_group_count
ORACLE["exact_group_count"] = """
SELECT event_type AS table_name, count(*) AS rows FROM events GROUP BY event_type
UNION ALL SELECT 'total', count(*) FROM events"""

FIRST_COLUMNS = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_tax")


def dedup_first_line(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *[F.col(c) for c in FIRST_COLUMNS]
    )
    lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return dedup_first(lines, ("l_orderkey",), FIRST_COLUMNS)


QUERIES["dedup_first"] = dedup_first_line
ORACLE["dedup_first"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate,
       l_returnflag, l_tax
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY {", ".join(FIRST_COLUMNS)}) AS rn FROM lineitem)
WHERE rn = 1"""


def dedup_pair(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag").distinct()


QUERIES["dedup_pair"] = dedup_pair
ORACLE["dedup_pair"] = "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem"


def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type").distinct()


QUERIES["distinct_values"] = distinct_values
ORACLE["distinct_values"] = "SELECT DISTINCT event_type FROM events"

ATTRIBUTES = ("l_returnflag", "l_linestatus", "l_linenumber")


def mode_dim(spark, sf_dir):
    return mode_dimension(table(spark, sf_dir, "lineitem"), "l_suppkey", ATTRIBUTES)


def _mode_sql(key: str, attribute: str, source: str) -> str:
    return (
        f"SELECT {key}, {attribute} FROM (SELECT {key}, {attribute}, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY count(*) DESC, {attribute}) AS rn FROM {source} "
        f"WHERE {attribute} IS NOT NULL GROUP BY {key}, {attribute}) WHERE rn = 1"
    )


def mode_sql(key: str, attributes, source: str) -> str:
    joins = " ".join(
        f"LEFT JOIN ({_mode_sql(key, a, source)}) m{i} ON k.{key} = m{i}.{key}"
        for i, a in enumerate(attributes)
    )
    picked = ", ".join(f"m{i}.{a}" for i, a in enumerate(attributes))
    return f"SELECT k.{key}, {picked} FROM (SELECT DISTINCT {key} FROM {source}) k {joins}"


QUERIES["mode_dim"] = mode_dim
ORACLE["mode_dim"] = mode_sql("l_suppkey", ATTRIBUTES, "lineitem")


def top_parts(spark, sf_dir):
    return top_values(table(spark, sf_dir, "lineitem"), "l_partkey", 10)


QUERIES["top_values"] = top_parts
ORACLE["top_values"] = """
SELECT l_partkey, count(*) AS frequency FROM lineitem
GROUP BY l_partkey ORDER BY frequency DESC, l_partkey LIMIT 10"""

METHOD_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_partkey": "l_partkey",
    "l_linenumber": "l_linenumber",
    "method_1": "CASE WHEN l_returnflag = 'R' THEN '00' WHEN l_returnflag = 'N' THEN NULL "
    "ELSE LPAD(CAST(l_linenumber AS STRING), 2, '0') END",
    "method_2": "CASE WHEN l_linestatus = 'F' THEN '00' ELSE "
    "LPAD(CAST(CAST(l_quantity AS INT) AS STRING), 2, '0') END",
}


def unpivot_methods(spark, sf_dir):
    lines = derive(table(spark, sf_dir, "lineitem"), METHOD_COLUMNS)
    return unpivot_codes(
        lines,
        ["l_orderkey", "l_partkey", "l_linenumber"],
        ["method_1", "method_2"],
        "kind",
        "method",
    )


_METHODS_SQL = derive_sql(METHOD_COLUMNS, "lineitem")
QUERIES["unpivot_codes"] = unpivot_methods
ORACLE["unpivot_codes"] = " UNION ALL ".join(
    f"SELECT l_orderkey, l_partkey, l_linenumber, '{m}' AS kind, {m} AS method "
    f"FROM ({_METHODS_SQL}) WHERE {m} IS NOT NULL AND {m} <> '00'"
    for m in ("method_1", "method_2")
)


def _satellite(spark, sf_dir, spec):
    return extract(contracted_lines(spark, sf_dir), spec, unique_on=("l_orderkey",))


def satellite_positive(spark, sf_dir):
    spec = Satellite(
        "stays",
        ("l_orderkey", "quantity", "discount_part"),
        where=F.col("discount_part") > 0,
        rules={
            "quantity": narrow(F.col("quantity"), "int"),
            "discount_part": F.round("discount_part", 4),
        },
        key=("l_orderkey",),
        dedup="first",
    )
    return _satellite(spark, sf_dir, spec)


QUERIES["extract_satellite_positive"] = satellite_positive
ORACLE["extract_satellite_positive"] = f"""
SELECT l_orderkey, CAST(trunc(quantity) AS INTEGER) AS quantity,
       round(discount_part, 4) AS discount_part
FROM ({CONTRACTED_SQL}) WHERE round(discount_part, 4) > 0"""


def satellite_flag(spark, sf_dir):
    spec = Satellite(
        "returns",
        ("l_orderkey", "l_suppkey"),
        where=F.col("l_returnflag") == "R",
        key=("l_orderkey",),
        dedup="first",
    )
    return _satellite(spark, sf_dir, spec)


QUERIES["extract_satellite_flag"] = satellite_flag
ORACLE["extract_satellite_flag"] = f"""
SELECT l_orderkey, l_suppkey FROM ({CONTRACTED_SQL}) WHERE l_returnflag = 'R'"""

# Codes over billing lines, so that duplicates within an order are really removed.
LINE_CODE = {
    "l_orderkey": "l_orderkey",
    "code": "CASE WHEN l_tax = 0.0 THEN NULL WHEN l_tax = 0.01 THEN '' WHEN l_tax = 0.02 THEN '000' "
    "WHEN l_tax = 0.03 THEN '0' || l_returnflag ELSE ' ' || LOWER(l_returnflag) || "
    "CAST(l_linenumber AS STRING) || chr(9) END",
}


def satellite_code(spark, sf_dir):
    lines = derive(table(spark, sf_dir, "lineitem"), LINE_CODE)
    code = F.col("code")
    spec = Satellite(
        "codes",
        ("l_orderkey", "code"),
        where=code.isNotNull() & (code != "") & ~code.startswith("0"),
        rules={"code": F.upper(F.btrim(code, F.lit(" \t")))},
        key=("l_orderkey",),
        dedup="first",
        order=("code",),
    )
    return extract(lines, spec)


QUERIES["extract_satellite_code"] = satellite_code
ORACLE["extract_satellite_code"] = rf"""
SELECT l_orderkey, min(code) AS code
FROM (SELECT l_orderkey, upper(regexp_replace(code, '^\s+|\s+$', '', 'g')) AS code
      FROM ({derive_sql(LINE_CODE, "lineitem")}))
WHERE code IS NOT NULL AND code <> '' AND NOT starts_with(code, '0')
GROUP BY l_orderkey"""


def satellite_pair(spark, sf_dir):
    lines = billing_lines(spark, sf_dir)
    spec = Satellite(
        "pairs",
        ("l_orderkey", "l_returnflag"),
        where=(F.col("l_linenumber") == 5) & (F.col("quantity") > 0),
        dedup="rows",
    )
    return extract(lines, spec)


QUERIES["extract_satellite_pair"] = satellite_pair
ORACLE["extract_satellite_pair"] = f"""
SELECT DISTINCT l_orderkey, l_returnflag FROM ({_LINES_SQL})
WHERE l_linenumber = 5 AND quantity > 0"""


def detail_keep_duplicates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")


QUERIES["detail_keep_duplicates"] = detail_keep_duplicates
ORACLE["detail_keep_duplicates"] = "SELECT l_orderkey, l_partkey FROM lineitem"
