import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.operators import extract as X
from wardmill.operators import keys as K
from wardmill.operators import profile as P
from wardmill.operators import quality as Q
from wardmill.operators.contract import contract, dedup_first
from wardmill.operators.keys import number_rows
from wardmill.operators.project import as_text, conform, extra_columns, union_as_text


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_contract_takes_the_first_row_whole(spark):
    df = spark.createDataFrame(
        [(1, 2, 10.0, 1, "b"), (1, 1, 5.0, 2, None), (1, 3, 1.0, 6, "c"), (2, 1, 7.0, 4, "z")],
        "k int, o int, v double, m int, t string",
    )
    out = contract(
        df, ["k"], sums=["v"], means=["m"], order=[F.col("o")], recomputed={"w": F.col("v") * 2}
    )
    assert out.columns == ["k", "o", "v", "m", "t", "w"]
    assert rows(out) == [(1, 1, 16.0, 3.0, None, 32.0), (2, 1, 7.0, 4.0, "z", 14.0)]


def test_contract_orders_by_names_or_expressions_alike(spark):
    df = spark.createDataFrame(
        [(1, 3, "a", 5), (1, 2, "z", 9), (1, 2, "b", 1), (2, None, "q", 4)],
        "k int, o int, t string, u int",
    )
    by_name = contract(df, ["k"], order=["o", "t"])
    by_expression = contract(df, ["k"], order=[F.col("o"), F.col("t")])
    assert by_name.columns == df.columns
    assert rows(by_name) == rows(by_expression) == [(1, 2, "b", 1), (2, None, "q", 4)]
    # The named columns are not carried a second time.
    assert "_o0" not in by_name._jdf.queryExecution().executedPlan().toString()


def test_contract_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v double")
    assert rows(contract(df, ["k"], sums=["v"])) == [(1, 0.0)]


def test_contract_does_not_depend_on_row_order(spark):
    data = [(i % 3, random.Random(i).randint(0, 4), i % 7) for i in range(200)]
    first = contract(spark.createDataFrame(data, "k int, o int, t int"), ["k"], order=[F.col("o")])
    random.Random(1).shuffle(data)
    second = contract(
        spark.createDataFrame(data, "k int, o int, t int").repartition(7),
        ["k"],
        order=[F.col("o")],
    )
    assert rows(first) == rows(second)


def test_dedup_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k int, v string, o int")
    assert rows(dedup_first(df, ["k"], [F.col("o")])) == [(1, "a", 1), (2, "c", 3)]


def test_union_as_text(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("2", 5)], "id string, extra int")
    assert rows(union_as_text([a, b], ["id", "name"])) == [("1", "x"), ("2", None)]


def test_conform(spark):
    schema = T.StructType(
        [
            T.StructField("a", T.ByteType()),
            T.StructField("b", T.IntegerType()),
            T.StructField("d", T.DateType()),
            T.StructField("s", T.StringType()),
        ]
    )
    df = spark.createDataFrame(
        [(300, 2.9, "2020-01-31", 1), (12, 1e12, "nope", 2)],
        "a bigint, b double, d string, other int",
    )
    out = conform(df, schema, fill_missing=True)
    assert out.schema == schema
    assert [tuple(map(str, r)) for r in out.collect()] == [
        ("None", "2", "2020-01-31", "None"),
        ("12", "None", "None", "None"),
    ]
    assert extra_columns(df, schema) == ["other"]
    assert conform(df, schema).columns == ["a", "b", "d"]


def test_mode_dimension_against_counting(spark):
    rng = random.Random(3)
    data = [
        (rng.randint(0, 4), rng.choice("abc"), rng.choice([None, 1, 2, 3])) for _ in range(300)
    ] + [(9, "x", None)]
    got = dict(
        (r[0], (r[1], r[2]))
        for r in X.mode_dimension(
            spark.createDataFrame(data, "k int, s string, n int"), "k", ["s", "n"]
        ).collect()
    )
    for key in {d[0] for d in data}:
        expected = []
        for i in (1, 2):
            counts = Counter(d[i] for d in data if d[0] == key and d[i] is not None)
            best = min(counts.items(), key=lambda kv: (-kv[1], kv[0])) if counts else (None,)
            expected.append(best[0])
        assert got[key] == tuple(expected)


def test_unpivot_codes(spark):
    df = spark.createDataFrame(
        [(1, "01", "00"), (2, None, "07"), (3, "00", None), (4, "02", "03")],
        "k int, a string, b string",
    )
    out = X.unpivot_codes(df, ["k"], ["a", "b"], "kind", "code")
    assert rows(out) == [(1, "a", "01"), (2, "b", "07"), (4, "a", "02"), (4, "b", "03")]


def test_extract_skips_the_shuffle_on_unique_input(spark):
    df = spark.createDataFrame([(1, 5), (2, 0)], "k int, v int")
    spec = X.Satellite("t", ("k", "v"), where=F.col("v") > 0, key=("k",), dedup="first")
    plan = X.extract(df, spec, unique_on=("k",))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert "Exchange" in X.extract(df, spec)._jdf.queryExecution().toString()


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(6)
    out = K.number_rows(df, "n", ["v"], partitions=7)
    assert out.where("n != v + 1").count() == 0
    assert out.count() == 5000


@pytest.mark.parametrize("order", [(), ("v",)])
def test_number_rows_with_copies_of_one_row(spark, order):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("v"))
    out = K.number_rows(df, "n", order, partitions=6)
    stats = out.agg(F.count("n"), F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(stats) == (3000, 3000, 1, 3000)
    assert out.where("v = 1").count() == 1000


def test_contract_with_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") < 10000, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("double").alias("v"),
        (-F.col("id")).alias("o"),
    )
    out = contract(df.repartition(6), ["k"], sums=["v"], order=[F.col("o")])
    assert out.count() == 20001
    hot = out.where("k = 0").first()
    assert (hot.v, hot.o) == (sum(range(10000)), -9999)


def test_values_at_ranks_against_sorting(spark):
    rng = random.Random(5)
    data = [float(rng.choice([1, 1, 1, rng.randint(0, 500)])) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double").repartition(5)
    out = K.values_at_ranks(df, "v", [F.lit(r) for r in (1, 700, 1500, 2000)], partitions=5)
    got = {r[0]: r[1] for r in out.collect()}
    ordered = sorted(data)
    assert got == {i: ordered[r - 1] for i, r in enumerate((1, 700, 1500, 2000))}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(K.orphan_keys(child, "fk", parent, "pk")) == [(7,), (8,)]
    top = K.orphan_frequency(child, "fk", parent, "pk", 1, "n")
    assert rows(top) == [(7, 2)]
    assert rows(K.keep_children(child, "fk", parent, "pk")) == [(1,)]


def test_missing_values_treats_null_as_a_value(spark):
    a = spark.createDataFrame([(1,), (None,), (3,), (3,)], "v int")
    b = spark.createDataFrame([(1,)], "v int")
    assert rows(K.missing_values(a, b)) == [(3,), (None,)]
    assert K.missing_values(b, a).isEmpty()


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "N_AIH int, t string")
    assert [tuple(r) for r in P.completeness(df).collect()] == [
        ("N_AIH", 3, 0, 0.0, True),
        ("t", 1, 2, 0.666667, False),
    ]
    assert [r.null_rate for r in P.completeness(df.limit(0)).collect()] == [0.0, 0.0]


def test_describe(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)] + [(None,)], "v double")
    got = {r[0]: r[1] for r in P.describe(df, "v").collect()}
    assert got == {
        "count": 5.0, "null_count": 1.0, "mean": 3.0, "std": pytest.approx(1.5811388),
        "min": 1.0, "25%": 2.0, "50%": 3.0, "75%": 4.0, "max": 5.0,
    }


def test_dataset_diff_against_all_pairs(spark):
    rng = random.Random(11)

    def version():
        return [
            (
                rng.choice([None, 1, 1, 1, 2, 3, rng.randint(4, 40)]),
                rng.choice("ab"),
                rng.choice([None, 1.0, 2.0, 0.0, -0.0]),
                rng.choice([None, "x", "y"]),
            )
            for _ in range(150)
        ]

    a, b = version(), version()
    schema = "k int, j string, v double, t string"
    got = {
        r["column"]: (r.equal, r.different)
        for r in P.dataset_diff(
            spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k", "j", "absent"]
        ).collect()
    }
    pairs, equal = 0, defaultdict(int)
    for x in a:
        for y in b:
            if x[0] is not None and x[:2] == y[:2]:
                pairs += 1
                for i, c in ((2, "v"), (3, "t")):
                    equal[c] += x[i] is not None and x[i] == y[i]
    assert got == {c: (equal[c], pairs - equal[c]) for c in ("v", "t")}


def test_dataset_diff_of_a_hot_key_counts_its_pairs(spark):
    """20,000 copies on each side are 400 million pairs, which must not be built."""
    a = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 4).alias("v"))
    b = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("v"))
    row = P.dataset_diff(a.repartition(4), b.repartition(4), ["k"]).first()
    assert (row.equal, row.different) == (4 * 5000 * 4000, 20000**2 - 4 * 5000 * 4000)


def test_dataset_diff_joins_keys_that_are_repeated_a_few_times(spark):
    """Three rows on each side are nine pairs of a key, fewer than the values its rows hold."""
    schema = "k int, t string, v double"
    a = spark.createDataFrame([(1, "x", 0.0), (1, "x", None), (1, "y", 1.0), (2, "z", 1.0)], schema)
    b = spark.createDataFrame([(1, "x", -0.0), (1, "y", 0.0), (1, None, 1.0), (3, "z", 1.0)], schema)
    few = P.dataset_diff(a, b, ["k"])
    assert {r.column: (r.equal, r.different) for r in few.collect()} == {"t": (3, 6), "v": (3, 6)}
    assert "explode(" not in few._jdf.queryExecution().optimizedPlan().toString()
    # With a key of 100 rows beside it, both ways add up.
    many = spark.range(100).select(F.lit(7).alias("k"), F.lit("x").alias("t"), F.lit(1.0).alias("v"))
    got = P.dataset_diff(a.unionByName(many), b.unionByName(many), ["k"])
    assert {r.column: (r.equal, r.different) for r in got.collect()} == {"t": (10003, 6), "v": (10003, 6)}


def test_dataset_diff_with_unique_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, t string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "y")], "k int, t string")
    assert [tuple(r) for r in P.dataset_diff(a, b, ["k"]).collect()] == [("t", 1, 1, 50.0)]


def test_discrepancy_reports(spark):
    df = spark.createDataFrame(
        [(10.0, 4.0, 6.0, None), (10.0, 4.0, 3.0, 1.0), (5.0, 9.0, -1.0, None)],
        "total double, a double, b double, c double",
    )
    difference = P.discrepancy(F.col("total"), [F.col(c) for c in "abc"])
    bad = P.discrepant(df, difference)
    assert rows(P.difference_histogram(bad, None)) == [(-3.0, 1), (2.0, 1)]
    assert rows(P.difference_histogram(bad, 1)) == [(-3.0, 1)]
    report = P.cost_quality(df, difference, [F.col(c) for c in ("total", "a", "b", "c")])
    assert tuple(report.first()) == (3, 2, 1, 66.67, 33.33)


CHECK_ROWS = [
    (1, "A01", 1, "2020-01-01", "2020-01-03", 2, 5.0, 10),
    (2, "a01", 9, "2020-01-05", "2020-01-03", 2, -1.0, 0),
    (2, None, None, None, "2020-01-03", None, None, 271),
    (None, "B12.5", 3, "2020-01-01", None, 1, 0.0, 270),
]


@pytest.fixture
def checked(spark):
    df = spark.createDataFrame(
        CHECK_ROWS, "k int, code string, sex int, a string, b string, n int, v double, e int"
    )
    df = df.withColumns({c: F.col(c).cast("date") for c in "ab"})
    parent = spark.createDataFrame([(1,)], "pk int")
    return {"t": df, "p": parent}


@pytest.mark.parametrize(
    ("make", "bad"),
    [
        (lambda: Q.not_null("t", "a"), 1),
        (lambda: Q.accepted_values("t", "sex", (1, 3)), 1),
        (lambda: Q.matches("t", "code", r"^[A-Z][0-9]{2,3}(\.[0-9])?$"), 1),
        (lambda: Q.in_order("t", "a", "b"), 1),
        (lambda: Q.within("t", "e", 0, 270), 2),
        (lambda: Q.non_negative("t", ("v",)), 1),
        (lambda: Q.recomputed("t", "n", F.date_diff("b", "a")), 1),
        (lambda: Q.UniqueCheck("t", ("k",)), 1),
        (lambda: Q.UniqueCheck("t", ("k", "code")), 0),
        (lambda: Q.RelationshipCheck("t", ("k",), "p", ("pk",)), 2),
        (lambda: Q.DistinctPerKeyCheck("t", "k", "e", 1), 1),
        (lambda: Q.DistinctPerKeyCheck("t", "k", "e", 2), 0),
    ],
)
def test_checks(checked, make, bad):
    check = make()
    score = Q.scorecard(checked, [check]).first()
    assert (score.violations, score.passed) == (bad, bad == 0)
    found = Q.violations(checked, check)
    if isinstance(check, Q.RelationshipCheck):
        assert found.agg(F.sum("occurrences")).first()[0] == bad
    else:
        assert found.count() == bad


def test_numbers_as_text_by_type(spark):
    """Doubles from writers that turn integers with gaps into doubles, and small amounts."""
    values = [4323100000001.0, 3.0, 0.0005, -2.5, 1e7, 12345678.25, None, float("nan"), 0.0]
    df = spark.createDataFrame([(v,) for v in values], "a double").selectExpr("a", "CAST(a AS FLOAT) AS f")
    got = [r.a for r in as_text(df, ["a"]).collect()]
    assert got == ["4323100000001", "3", "0.0005", "-2.5", "10000000", "12345678.25", None, None, "0"]
    other = spark.sql("SELECT CAST(12.50 AS DECIMAL(9,2)) AS d, CAST(7 AS TINYINT) AS t, CAST(0.1 AS FLOAT) AS f")
    assert as_text(other, ["d", "t", "f"]).first() == ("12.50", "7", "0.1")
    exact = spark.sql("SELECT CAST(774 AS DECIMAL(18,2)) AS a, CAST(-71.1 AS DECIMAL(18,2)) AS b")
    assert as_text(exact, ["a", "b"]).first() == ("774.00", "-71.10")


def test_diff_casts_to_the_left_type_and_writes_keys_once(spark):
    a = spark.createDataFrame([(1, 5, 2.5), (2, 6, None)], "k long, n int, v double")
    b = spark.createDataFrame([("1", "5", "2.5"), ("2", "x", "1"), ("y", "5", "1")], "k string, n string, v string")
    got = {r["column"]: (int(r.equal), int(r.different)) for r in P.dataset_diff(a, b, ["k"]).collect()}
    assert got == {"n": (1, 1), "v": (1, 1)}


def test_counts_of_a_hot_key_do_not_overflow(spark):
    """Products of counts are decimals, wider than a long."""
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    types = dict(P.dataset_diff(a, a, ["k"]).dtypes)
    assert types["equal"] == types["different"] == "decimal(38,0)"


def test_dedup_of_a_frame_that_is_all_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert sorted(map(tuple, dedup_first(df, ("a", "b")).collect())) == [(1, 2), (3, 4)]


def test_a_check_without_its_table_has_not_passed(spark):
    tables = {"t": spark.createDataFrame([(1,)], "a int")}
    checks = [Q.not_null("t", "a"), Q.not_null("u", "a"), Q.RelationshipCheck("t", ("a",), "p", ("b",))]
    got = {(r.table_name, r.passed, r.reason) for r in Q.scorecard(tables, checks).collect()}
    assert got == {("t", True, None), ("u", False, "no table u"), ("t", False, "no table p")}


def test_a_total_order_is_numbered_with_one_write(spark):
    df = spark.createDataFrame([(i * 7 % 50,) for i in range(50)], "a int").repartition(4)
    rows = number_rows(df, "n", order=("a",), partitions=3, total=True).collect()
    assert sorted(map(tuple, rows)) == [(i + 1, i) for i in range(50)]


def test_key_checks_of_whole_numbers_against_brute_force(spark):
    """Dense and scattered, negative, repeated and missing keys; a whole word without parents."""
    rng = random.Random(5)
    pool = [*range(-70, 200), *(rng.randrange(-(2**63), 2**63) for _ in range(40)), 2**63 - 1, -(2**63), None]
    child = [rng.choice(pool) for _ in range(400)] + [7] * 50 + [10_000 + i for i in range(70)]
    parent = list({k for k in pool if k is not None and rng.random() < 0.7}) + [None]
    once = list(range(-64, 64)) + [None, None]
    tables = {
        "c": spark.createDataFrame([(k,) for k in child], "k long"),
        "p": spark.createDataFrame([(k,) for k in parent], "k long"),
        "o": spark.createDataFrame([(k,) for k in once], "k short"),
    }
    checks = [
        Q.UniqueCheck("c", ("k",)), Q.UniqueCheck("p", ("k",)), Q.UniqueCheck("o", ("k",)),
        Q.RelationshipCheck("c", ("k",), "p", ("k",)), Q.RelationshipCheck("p", ("k",), "c", ("k",)),
        Q.RelationshipCheck("o", ("k",), "c", ("k",)), Q.RelationshipCheck("o", ("k",), "o", ("k",)),
    ]
    values = {"c": child, "p": parent, "o": once}

    def brute(check):
        own = Counter(k for k in values[check.table] if k is not None)
        if isinstance(check, Q.UniqueCheck):
            return sum(n > 1 for n in own.values())
        known = set(values[check.to_table])
        return sum(n for k, n in own.items() if k not in known)

    expected = Counter((c.name, c.table, brute(c)) for c in checks)
    got = Counter((r.check_name, r.table_name, r.violations) for r in Q.scorecard(tables, checks).collect())
    assert got == expected
    assert expected["relationships", "o", 0] >= 1 and brute(checks[3]) > 70
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r.violations for r in Q.scorecard(empty, checks).collect()} == {0}


@pytest.mark.parametrize("kind", ["decimal(10,2)", "double", "float", "int", "decimal(12,0)", "string", "short"])
def test_keys_compare_in_their_common_type(spark, kind):
    child = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 12)], "k long").selectExpr("k", "CAST(k AS int) AS j")
    parent = spark.range(1, 10).selectExpr(f"CAST(id AS {kind}) AS pk", "CAST(id AS double) AS pj")
    checks = [
        Q.RelationshipCheck("c", ("k",), "p", ("pk",)), Q.RelationshipCheck("c", ("k", "j"), "p", ("pk", "pj")),
        Q.RelationshipCheck("p", ("pk",), "c", ("k",)),
    ]
    got = [r.violations for r in Q.scorecard({"c": child, "p": parent}, checks).collect()]
    assert sorted(got) == [1, 1, 6]


def test_clean_whole_number_keys_are_exchanged_as_words(spark):
    """What is exchanged for 64 neighbouring keys is one row, and clean keys leave no row behind."""
    df = spark.range(0, 64_000, 1, 1).withColumnRenamed("id", "k")
    words = [Q._number_use(("k",), [T.LongType()], 0, 1), Q._number_use(("k",), [T.LongType()], 1, 1),
             Q._number_use(("k",), [T.LongType()], 1, 0)]
    keys = df.select(F.inline(F.array(*words)))
    assert keys.groupBy("g", "word").count().count() == 2 * 1000
    assert all(part.count() == 0 for part in Q._count_numbers(keys, [1]))


def test_contract_takes_the_first_of_rows_whose_fields_are_packed(spark):
    """Nulls, the least and the largest values and texts with the marks of the packed form."""
    schema = "k int, a string, b string, c string, t tinyint, s smallint, i int, f boolean, d date, l long"
    texts = [None, "", "\x00", "\x01", "\x01\x01", "\x00\x01", "a", "a\x00b", "a\x01", "ab", "é", "\x02"]
    numbers = [(None, None, None, None, None, None), (-128, -32768, -(2**31), False, date(1, 1, 1), -(2**63)),
               (127, 32767, 2**31 - 1, True, date(9999, 12, 31), 2**63 - 1), (0, -1, 0, False, date(1970, 1, 1), 0)]
    draw = random.Random(3)
    data = [
        (k, *[draw.choice(texts) for _ in "abc"], *[draw.choice(numbers)[j] for j in range(6)])
        for k in range(150)
        for _ in range(draw.randint(1, 12))
    ]

    def rank(row):
        known = [(v is not None, v.encode() if isinstance(v, str) else v) for v in row[1:]]
        return [(there, v if there else 0) for there, v in known]

    best = {}
    for row in data:
        best[row[0]] = min(best.get(row[0], row), row, key=rank)
    df = spark.createDataFrame(data, schema).repartition(3)
    got = contract(df, ["k"])
    assert got.dtypes == df.dtypes
    assert {row.k: tuple(row) for row in got.collect()} == best
    # Three texts share a field, four small numbers another; the date and the long have their own.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_f3" in plan and "_f4" not in plan


def test_keys_are_read_again_only_where_a_word_is_faulty(spark, tmp_path):
    """A column in many groups gives one row a key, and clean tables are not in the second pass."""
    spark.range(200).selectExpr("id AS whole").write.parquet(str(tmp_path / "clean"))
    spark.range(100).selectExpr("id * 2 AS part", "id % 60 AS often").write.parquet(str(tmp_path / "faulty"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("clean", "faulty")}
    checks = [
        Q.UniqueCheck("clean", ("whole",)), Q.UniqueCheck("faulty", ("part",)), Q.UniqueCheck("faulty", ("often",)),
        Q.RelationshipCheck("clean", ("whole",), "faulty", ("part",)),
        Q.RelationshipCheck("faulty", ("part",), "clean", ("whole",)),
        Q.RelationshipCheck("faulty", ("often",), "clean", ("whole",)),
    ]
    scored = Q.scorecard(tables, checks)
    got = [(r.table_name, r.column_name, r.violations) for r in scored.collect()]
    assert Counter(got) == Counter([
        ("clean", "whole", 0), ("faulty", "part", 0), ("faulty", "often", 40),
        ("clean", "whole", 100), ("faulty", "part", 0), ("faulty", "often", 0),
    ])
    few = [c for c in checks if c.table == "faulty"]
    plan = Q.scorecard(tables, few)._jdf.queryExecution().optimizedPlan().toString()
    assert "often#" in plan and "whole#" not in plan


def test_rows_that_are_numbered_stay_in_place(spark):
    """What the rows are joined with is small and known to be, so the rows are not shuffled."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20000")
    try:
        plan = number_rows(spark.range(200_000), "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
