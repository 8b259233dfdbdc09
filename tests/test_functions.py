from datetime import date

import pytest
from pyspark.sql import functions as F

from wardmill import functions as W


def test_coerce_int(values):
    rows = ["0012", "abc", None, "300", "12.5", " 7 ", "", "-4", "+5", "9" * 30, "\t8\n"]
    assert values(rows, "string", lambda c: W.coerce_int(c, "tinyint")) == [
        12, 0, 0, 0, 0, 7, 0, -4, 5, 0, 8,
    ]
    assert values(["300", "-4"], "string", lambda c: W.coerce_int(c, "int", low=0)) == [300, 0]


@pytest.mark.parametrize(
    ("type_name", "low", "high"),
    [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -(2**31), 2**31 - 1)],
)
def test_narrow_at_the_limits(values, type_name, low, high):
    rows = [low - 1, low, high, high + 1, None]
    assert values(rows, "bigint", lambda c: W.narrow(c, type_name)) == [
        None, low, high, None, None,
    ]


def test_narrow_truncates_like_a_cast(values):
    rows = [2.9, -2.9, 127.9, 128.0, float("nan"), None]
    assert values(rows, "double", lambda c: W.narrow(c, "tinyint")) == [2, -2, 127, None, None, None]


def test_clean_money(values):
    rows = ["12,50", " 1 000", "-3,2", "1.234,56", None, "", "12d", "1e2", "abc", "NaN", "5.", ".5"]
    assert values(rows, "string", W.clean_money) == [
        12.5, 1000.0, 3.2, 0.0, 0.0, 0.0, 0.0, 100.0, 0.0, 0.0, 5.0, 0.5,
    ]


def test_to_double_imputes_nothing(values):
    rows = ["12.5", "-3", "12,5", "12d", None, "1e-2", "inf"]
    assert values(rows, "string", W.to_double) == [12.5, -3.0, None, None, None, 0.01, None]


def test_parse_date(values):
    rows = ["20230228", "20230230", "", None, "2023-02-28", "20230228 ", "120230228", "00000000"]
    assert values(rows, "string", W.parse_date) == [date(2023, 2, 28)] + [None] * 7


@pytest.mark.parametrize(
    ("at", "born", "age"),
    [
        ("2001-02-28", "2000-02-29", 0),
        ("2001-03-01", "2000-02-29", 1),
        ("2000-01-01", "2010-01-01", 0),
        ("2020-05-05", "1820-05-05", 150),
        ("2020-05-04", "1990-05-05", 29),
        ("2020-05-05", "1990-05-05", 30),
        ("2020-05-05", None, None),
        (None, "1990-05-05", None),
    ],
)
def test_age(spark, at, born, age):
    df = spark.createDataFrame([(at, born)], "a string, b string")
    row = df.select(W.age_years(F.col("a").cast("date"), F.col("b").cast("date"))).first()
    assert row[0] == age


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("2020-01-01", "2020-01-01", 0),
        ("2020-01-05", "2020-01-01", -4),
        ("2020-01-01", None, 0),
        ("1900-01-01", "2020-01-01", 0),
    ],
)
def test_stay(spark, start, end, days):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    row = df.select(W.stay_days(F.col("a").cast("date"), F.col("b").cast("date"))).first()
    assert row[0] == days


def test_region_code(values):
    rows = [
        "431490", "5300108", "539999", "4314902", "12", None, "x", "-12", "+12", " 431490\t",
        "43 490", "12345 7", "",
    ]
    assert values(rows, "string", W.region_code) == [
        431490, 530010, 530010, 431490, 12, 0, 0, 0, 0, 431490, 0, 0, 0,
    ]


def test_code_text(values):
    rows = [" a09 ", "", None, "0000", "\t b1 ", "  ", "0a", "0"]
    assert values(rows, "string", W.code_text) == ["A09", "0", "0", "0", "B1", "0", "0A", "0"]


def test_clip_keeps_null(values):
    assert values([-5, 5, 500, None], "int", lambda c: W.clip(c, 0, 350)) == [0, 5, 350, None]


def test_recode(values):
    assert values([0, 7, None], "int", lambda c: W.recode(c, {0: 10})) == [10, 7, None]
    assert values([0], "int", lambda c: W.recode(c, {})) == [0]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 5)], "a bigint, b bigint")
    shares = df.select(W.percent(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in shares] == [33.33, None, 0.0]
