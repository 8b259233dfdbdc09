"""Scalar cleaning rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import (
    CODE_TEXT,
    DATE_TEXT,
    INTEGER_TEXT,
    LINE_KEY,
    MONEY_TEXT,
    PRICE_DAYS,
    QUANTITY,
    REGION_TEXT,
    SHIP_DAY,
    derive,
    derive_sql,
    sql_age,
    sql_clip,
    sql_code,
    sql_date,
    sql_int,
    sql_money,
    sql_region,
    sql_strip,
    table,
)
from wardmill.functions import (
    age_years,
    clean_money,
    clip,
    code_text,
    coerce_int,
    correct_by,
    is_blank_code,
    parse_date,
    recode,
    region_code,
    stay_days,
    strip_text,
    to_double,
    to_int,
    total_of,
)
from wardmill.operators.extract import valid_code

QUERIES = {}
ORACLE = {}
KEY = list(LINE_KEY)
KEY_SQL = ", ".join(KEY)


def _lines(spark, sf_dir, **columns):
    return derive(table(spark, sf_dir, "lineitem"), {**LINE_KEY, **columns})


def _lines_sql(**columns):
    return derive_sql({**LINE_KEY, **columns}, "lineitem")


def coerce_int_groups(spark, sf_dir):
    t = F.col("t")
    return _lines(spark, sf_dir, t=INTEGER_TEXT).select(
        *KEY,
        coerce_int(t, "bigint").alias("as_bigint"),
        coerce_int(t, "int").alias("as_int"),
        coerce_int(t, "smallint").alias("as_smallint"),
        coerce_int(t, "tinyint").alias("as_tinyint"),
        coerce_int(t, "bigint", low=0).alias("floored"),
    )


QUERIES["coerce_int_groups"] = coerce_int_groups
ORACLE["coerce_int_groups"] = f"""
SELECT {KEY_SQL}, {sql_int("t", "BIGINT")} AS as_bigint, {sql_int("t", "INTEGER")} AS as_int,
       {sql_int("t", "SMALLINT")} AS as_smallint, {sql_int("t", "TINYINT")} AS as_tinyint,
       greatest({sql_int("t", "BIGINT")}, 0) AS floored
FROM ({_lines_sql(t=INTEGER_TEXT)})"""


def clean_money_text(spark, sf_dir):
    return _lines(spark, sf_dir, t=MONEY_TEXT).select(
        *KEY, clean_money(F.col("t")).alias("amount")
    )


QUERIES["clean_money"] = clean_money_text
ORACLE["clean_money"] = f"""
SELECT {KEY_SQL}, {sql_money("t")} AS amount FROM ({_lines_sql(t=MONEY_TEXT)})"""


def derive_total(spark, sf_dir):
    price, tax, discount = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    total = total_of(price, price * tax, price * discount)
    return table(spark, sf_dir, "lineitem").select(*KEY, F.round(total, 4).alias("total"))


QUERIES["derive_total"] = derive_total
ORACLE["derive_total"] = f"""
SELECT {KEY_SQL},
       round(l_extendedprice + l_extendedprice * l_tax + l_extendedprice * l_discount, 4) AS total
FROM lineitem"""


def parse_dates(spark, sf_dir):
    return _lines(spark, sf_dir, t=DATE_TEXT).select(*KEY, parse_date(F.col("t")).alias("day"))


QUERIES["parse_dates"] = parse_dates
ORACLE["parse_dates"] = f"""
SELECT {KEY_SQL}, {sql_date("t")} AS day FROM ({_lines_sql(t=DATE_TEXT)})"""

# Birth dates far back enough to reach the upper limit; missing for some lines.
BIRTH = f"CASE WHEN l_returnflag = 'N' THEN NULL ELSE {SHIP_DAY} - {PRICE_DAYS} END"


def _with_orders(spark, sf_dir, **columns):
    shipped = _lines(spark, sf_dir, **columns)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("ordered")
    )
    return shipped.join(orders, shipped.l_orderkey == orders.o_orderkey)


def _with_orders_sql(**columns):
    return (
        f"SELECT l.*, CAST(o_orderdate AS DATE) AS ordered FROM ({_lines_sql(**columns)}) l "
        "JOIN orders ON l_orderkey = o_orderkey"
    )


def age_in_years(spark, sf_dir):
    return _with_orders(spark, sf_dir, shipped=SHIP_DAY, born=BIRTH).select(
        *KEY,
        age_years(F.col("shipped"), F.col("ordered")).alias("age_of_order"),
        age_years(F.col("shipped"), F.col("born")).alias("age"),
    )


QUERIES["age_years"] = age_in_years
ORACLE["age_years"] = f"""
SELECT {KEY_SQL}, CAST({sql_age("shipped", "ordered")} AS SMALLINT) AS age_of_order,
       CAST({sql_age("shipped", "born")} AS SMALLINT) AS age
FROM ({_with_orders_sql(shipped=SHIP_DAY, born=BIRTH)})"""

# An end date that may be missing or too far away for a small integer.
END_DAY = f"CASE WHEN l_returnflag = 'N' THEN NULL ELSE {SHIP_DAY} + {PRICE_DAYS} END"


def stay_in_days(spark, sf_dir):
    return _with_orders(spark, sf_dir, shipped=SHIP_DAY, ended=END_DAY).select(
        *KEY,
        stay_days(F.col("ordered"), F.col("shipped")).alias("to_ship"),
        stay_days(F.col("ordered"), F.col("ended")).alias("to_end"),
    )


QUERIES["stay_days"] = stay_in_days
ORACLE["stay_days"] = f"""
SELECT {KEY_SQL}, CAST(date_diff('day', ordered, shipped) AS SMALLINT) AS to_ship,
       COALESCE(TRY_CAST(date_diff('day', ordered, ended) AS SMALLINT), 0) AS to_end
FROM ({_with_orders_sql(shipped=SHIP_DAY, ended=END_DAY)})"""


def normalize_region_code(spark, sf_dir):
    return _lines(spark, sf_dir, t=REGION_TEXT).select(
        *KEY, region_code(F.col("t")).alias("region")
    )


QUERIES["normalize_region_code"] = normalize_region_code
ORACLE["normalize_region_code"] = f"""
SELECT {KEY_SQL}, {sql_region("t")} AS region FROM ({_lines_sql(t=REGION_TEXT)})"""

NATIONALITY = "CASE WHEN p_size <= 5 THEN 0 WHEN p_size <= 7 THEN NULL ELSE p_size * 9 END"


def recode_clip(spark, sf_dir):
    parts = derive(table(spark, sf_dir, "part"), {"p_partkey": "p_partkey", "n": NATIONALITY})
    n = F.col("n")
    return parts.select(
        "p_partkey",
        clip(recode(n, {0: 10}), 0, 350).alias("nationality"),
        clip(recode(coerce_int(n, "smallint"), {0: 10}), 0, 350).alias("filled"),
        coerce_int(n, "smallint", 0, 264).alias("ethnicity"),
        coerce_int(n, "tinyint", 0, 99).alias("race"),
    )


QUERIES["recode_clip"] = recode_clip
ORACLE["recode_clip"] = f"""
SELECT p_partkey,
       {sql_clip("CASE WHEN n = 0 THEN 10 ELSE n END", 0, 350)} AS nationality,
       {sql_clip("CASE WHEN COALESCE(n, 0) = 0 THEN 10 ELSE n END", 0, 350)} AS filled,
       {sql_clip("COALESCE(n, 0)", 0, 264)} AS ethnicity,
       {sql_clip("COALESCE(TRY_CAST(n AS TINYINT), 0)", 0, 99)} AS race
FROM ({derive_sql({"p_partkey": "p_partkey", "n": NATIONALITY}, "part")})"""

ETHNICITY = f"CASE WHEN l_returnflag = 'A' THEN 0 ELSE {QUANTITY} END"


def cross_column_fix(spark, sf_dir):
    rows = _lines(spark, sf_dir, ethnicity=ETHNICITY)
    race, ethnicity = F.col("l_linenumber"), F.col("ethnicity")
    return rows.select(
        *KEY, "ethnicity", correct_by(race, (race != 5) & (ethnicity != 0), 5).alias("race")
    )


QUERIES["cross_column_fix"] = cross_column_fix
ORACLE["cross_column_fix"] = f"""
SELECT {KEY_SQL}, ethnicity,
       CASE WHEN l_linenumber <> 5 AND ethnicity <> 0 THEN 5 ELSE l_linenumber END AS race
FROM ({_lines_sql(ethnicity=ETHNICITY)})"""


def normalize_code_text(spark, sf_dir):
    parts = derive(table(spark, sf_dir, "part"), {"p_partkey": "p_partkey", "t": CODE_TEXT})
    t = F.col("t")
    return parts.select(
        "p_partkey",
        code_text(t).alias("code"),
        strip_text(t).alias("stripped"),
        F.upper(strip_text(t)).alias("upper_stripped"),
    )


QUERIES["normalize_code_text"] = normalize_code_text
ORACLE["normalize_code_text"] = f"""
SELECT p_partkey, {sql_code("t")} AS code, {sql_strip("t")} AS stripped,
       upper({sql_strip("t")}) AS upper_stripped
FROM ({derive_sql({"p_partkey": "p_partkey", "t": CODE_TEXT}, "part")})"""


def coerce_types_only(spark, sf_dir):
    rows = _lines(spark, sf_dir, money=MONEY_TEXT, day=DATE_TEXT, n=INTEGER_TEXT)
    return rows.select(
        *KEY,
        to_double(F.col("money")).alias("amount"),
        parse_date(F.col("day")).alias("day"),
        to_int(F.col("n"), "smallint").alias("as_smallint"),
        to_int(F.col("n"), "tinyint").alias("as_tinyint"),
    )


def _typed_int(type_name):
    return (
        "CASE WHEN regexp_full_match(trim(n), '[+-]?[0-9]+') "
        f"THEN TRY_CAST(trim(n) AS {type_name}) END"
    )


QUERIES["coerce_types_only"] = coerce_types_only
ORACLE["coerce_types_only"] = f"""
SELECT {KEY_SQL},
       CASE WHEN regexp_full_match(trim(money), '[+-]?[0-9]+([.][0-9]*)?')
            THEN TRY_CAST(trim(money) AS DOUBLE) END AS amount,
       {sql_date("day")} AS day,
       {_typed_int("SMALLINT")} AS as_smallint, {_typed_int("TINYINT")} AS as_tinyint
FROM ({_lines_sql(money=MONEY_TEXT, day=DATE_TEXT, n=INTEGER_TEXT)})"""


def filter_valid_codes(spark, sf_dir):
    parts = derive(table(spark, sf_dir, "part"), {"p_partkey": "p_partkey", "t": CODE_TEXT})
    stripped = parts.select("p_partkey", strip_text(F.col("t")).alias("code"))
    code = F.col("code")
    clean = ~is_blank_code(code) & ~code.startswith("0")
    return stripped.where(clean | valid_code(code, ("", "0", "0000")) & code.endswith("7"))


QUERIES["filter_valid_codes"] = filter_valid_codes
ORACLE["filter_valid_codes"] = f"""
SELECT p_partkey, code FROM (
    SELECT p_partkey, {sql_strip("t")} AS code
    FROM ({derive_sql({"p_partkey": "p_partkey", "t": CODE_TEXT}, "part")}))
WHERE (code IS NOT NULL AND code <> '' AND NOT regexp_full_match(code, '0+')
       AND NOT starts_with(code, '0'))
   OR (code IS NOT NULL AND code NOT IN ('', '0', '0000') AND code LIKE '%7')"""

COHORT_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_returnflag", "l_linestatus", "l_discount",
)


def filter_isin_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.where(
        F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(6, 7)
    ).select(*COHORT_COLUMNS)


QUERIES["filter_isin_extract"] = filter_isin_extract
ORACLE["filter_isin_extract"] = f"""
SELECT {", ".join(COHORT_COLUMNS)} FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_linenumber NOT IN (6, 7)"""
