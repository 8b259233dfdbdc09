"""Reading the given tables, and derivations that Spark and the oracle share.

The given tables hold no dirty values, so dirt is derived from other columns by SQL
expressions that mean the same to both engines. Only these inputs are shared: what the
operators do with them is written separately on each side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select columns given as SQL expressions."""
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def derive_sql(columns: Mapping[str, str], source: str) -> str:
    """The same selection as SQL text."""
    items = ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    return f"SELECT {items} FROM {source}"


SHIP_DAY = "CAST(l_shipdate AS DATE)"
PRICE_TEXT = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)"
PRICE_DAYS = "CAST(FLOOR(l_extendedprice) AS INT)"
QUANTITY = "CAST(l_quantity AS INT)"


def day_text(day: str) -> str:
    """``yyyyMMdd`` text of a date expression."""
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS STRING)"


LINE_KEY = {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_linenumber": "l_linenumber"}

INTEGER_TEXT = """CASE WHEN l_discount = 0.0 THEN NULL
    WHEN l_discount = 0.01 THEN 'abc'
    WHEN l_discount = 0.02 THEN ''
    WHEN l_discount = 0.03 THEN '12.5'
    WHEN l_discount = 0.04 THEN ' ' || CAST(l_partkey AS STRING) || ' '
    WHEN l_discount = 0.05 THEN '-' || CAST(l_suppkey AS STRING)
    WHEN l_discount = 0.06 THEN LPAD(CAST(l_orderkey AS STRING), 12, '0')
    ELSE CAST(l_partkey AS STRING) END"""

MONEY_TEXT = f"""CASE WHEN l_tax = 0.0 THEN NULL
    WHEN l_tax = 0.01 THEN '- ' || {PRICE_TEXT}
    WHEN l_tax = 0.02 THEN '1.' || REPLACE({PRICE_TEXT}, '.', ',')
    WHEN l_tax = 0.03 THEN ' ' || REPLACE({PRICE_TEXT}, '.', ',') || ' '
    WHEN l_tax = 0.04 THEN 'R$ ' || {PRICE_TEXT}
    WHEN l_tax = 0.05 THEN {PRICE_TEXT} || 'd'
    WHEN l_tax = 0.06 THEN REPLACE({PRICE_TEXT}, '.', ',')
    ELSE {PRICE_TEXT} END"""

DATE_TEXT = f"""CASE WHEN l_linenumber = 1
        THEN SUBSTRING({day_text(SHIP_DAY)}, 1, 4) || '0230'
    WHEN l_linenumber = 2 THEN ''
    WHEN l_linenumber = 3 THEN {day_text(SHIP_DAY)} || ' '
    WHEN l_linenumber = 4 THEN CAST({SHIP_DAY} AS STRING)
    WHEN l_linenumber = 5 THEN NULL
    ELSE {day_text(SHIP_DAY)} END"""

REGION_TEXT = """CASE WHEN l_discount = 0.0 THEN NULL
    WHEN l_discount = 0.01 THEN '53' || LPAD(CAST(l_suppkey AS STRING), 5, '0')
    WHEN l_discount = 0.02 THEN ' 4314902 '
    WHEN l_discount = 0.03 THEN CAST(l_linenumber AS STRING)
    WHEN l_discount = 0.04 THEN 'x'
    WHEN l_discount = 0.05 THEN '-12'
    WHEN l_discount = 0.06 THEN chr(9) || '431490'
    WHEN l_discount = 0.07 THEN '43 490'
    WHEN l_discount = 0.08 THEN CAST(430000 + l_suppkey AS STRING) || '7'
    ELSE CAST(430000 + l_suppkey AS STRING) END"""

CODE_TEXT = """CASE WHEN p_size <= 4 THEN NULL
    WHEN p_size <= 8 THEN '  '
    WHEN p_size <= 12 THEN '0000'
    WHEN p_size <= 16 THEN chr(9) || '0' || chr(9)
    WHEN p_size <= 20 THEN '0' || p_brand
    WHEN p_size <= 30 THEN ' ' || LOWER(p_brand) || chr(9)
    WHEN p_size <= 40 THEN LOWER(p_type) || ' '
    ELSE p_brand END"""

# A supplier key that is sometimes null and sometimes points nowhere.
SUPPLIER_REF = """CASE WHEN l_tax = 0.08 THEN NULL
    WHEN l_discount = 0.1 THEN l_suppkey + 1000000 + l_linenumber
    ELSE l_suppkey END"""


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def sql_int(text: str, type_name: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') "
        f"THEN COALESCE(TRY_CAST(trim({text}) AS {type_name}), 0) ELSE 0 END"
    )


def sql_age(at: str, born: str) -> str:
    years = (
        f"year({at}) - year({born}) - CASE WHEN month({at}) < month({born}) "
        f"OR (month({at}) = month({born}) AND day({at}) < day({born})) THEN 1 ELSE 0 END"
    )
    return (
        f"CASE WHEN {at} IS NULL OR {born} IS NULL THEN NULL "
        f"WHEN {years} < 0 THEN 0 WHEN {years} > 150 THEN 150 ELSE {years} END"
    )


def sql_clip(value: str, low: int, high: int) -> str:
    return f"CASE WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END"


def sql_money(text: str) -> str:
    cleaned = f"replace(replace(replace({text}, ',', '.'), ' ', ''), '-', '')"
    number = r"[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+]?[0-9]+)?"
    return (
        f"CASE WHEN regexp_full_match({cleaned}, '{number}') "
        f"THEN COALESCE(TRY_CAST({cleaned} AS DOUBLE), 0.0) ELSE 0.0 END"
    )


def sql_date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{8}}') "
        f"THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) END"
    )


def sql_region(text: str) -> str:
    stripped = f"COALESCE({sql_strip(text)}, '000000')"
    whole = f"CASE WHEN starts_with({stripped}, '53') THEN '530010' ELSE {stripped} END"
    padded = f"lpad(substring({whole}, 1, 6), 6, '0')"
    return (
        f"CASE WHEN regexp_full_match({padded}, '[0-9]+') THEN CAST({padded} AS BIGINT) "
        f"ELSE CAST(0 AS BIGINT) END"
    )


def sql_code(text: str) -> str:
    code = f"upper({sql_strip(text)})"
    return f"CASE WHEN {code} IS NULL OR regexp_full_match({code}, '0*') THEN '0' ELSE {code} END"
