"""Profiling and comparison reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions.numeric import fit, percent
from wardmill.operators.keys import values_at_ranks
from wardmill.session import stage

# The columns a completeness report marks as critical.
CRITICAL = ("N_AIH", "CNES", "PROC_REA", "DT_INTER")
# Quartiles of a summary.
QUARTILES = (0.25, 0.5, 0.75)


def completeness(df: DataFrame, critical: Sequence[str] = CRITICAL) -> DataFrame:
    """Per column: non-null and null counts, null rate (6 decimals), critical flag."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("non_null"),
                (F.col("_rows") - F.col(f"n{i}")).alias("null"),
                F.lit(c in critical).alias("critical"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    flat = counts.select(F.inline(rows))
    total = F.col("null") + F.col("non_null")
    rate = F.round(F.coalesce(F.try_divide(F.col("null"), total), F.lit(0.0)), 6)
    return flat.select("column", "non_null", "null", rate.alias("null_rate"), "critical")


def validity_share(df: DataFrame, valid: Column) -> DataFrame:
    """Rows with a valid and an invalid value, and the percentage kept."""
    counted = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce(valid, F.lit(False))).alias("valid"),
    )
    return counted.select(
        "total",
        "valid",
        (F.col("total") - F.col("valid")).alias("invalid"),
        percent(F.col("valid"), F.col("total")).alias("percent_valid"),
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent non-null values, ties by value."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("frequency")
    )
    return counted.orderBy(F.desc("frequency"), F.asc(column)).limit(n)


def largest(df: DataFrame, by: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the largest value, ties by the given columns."""
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(n)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """A sample to look at: the first ``n`` rows in a stated order, so that it can be repeated."""
    return df.orderBy(*[F.asc(c) for c in order]).limit(n)


def discrepancy(total: Column, parts: Sequence[Column]) -> Column:
    """Stored total less the sum of its components; a missing component counts as 0."""
    return total - reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])


def discrepant(df: DataFrame, difference: Column, tolerance: float = 1.0) -> DataFrame:
    """Rows whose difference exceeds the tolerance, with the difference to the cent."""
    return df.where(F.abs(difference) > F.lit(tolerance)).select(
        "*", F.round(difference, 2).alias("difference")
    )


def difference_histogram(rows: DataFrame, n: int | None) -> DataFrame:
    """Differences with their number of rows: all of them, or the ``n`` most frequent."""
    if n is not None:
        return top_values(rows, "difference", n).withColumnRenamed("frequency", "occurrences")
    return rows.groupBy("difference").agg(F.count("*").alias("occurrences"))


def cost_quality(
    df: DataFrame, difference: Column, amounts: Sequence[Column], tolerance: float = 1.0
) -> DataFrame:
    """Discrepant rows and rows with any negative amount, counted in one scan."""
    negative = reduce(or_, [a < 0 for a in amounts])
    counted = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.abs(difference) > F.lit(tolerance)).alias("discrepant"),
        F.count_if(negative).alias("negative"),
    )
    return counted.select(
        "*",
        percent(F.col("discrepant"), F.col("total")).alias("percent_discrepant"),
        percent(F.col("negative"), F.col("total")).alias("percent_negative"),
    )


def describe(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Summary as (statistic, value): count, null_count, mean, std, min, quartiles, max.

    Quartiles are values of the column: the one whose rank is nearest to q(n-1).
    """
    c = F.col(column)
    base = df.agg(
        F.count(c).cast("double").alias("count"),
        F.count_if(c.isNull()).cast("double").alias("null_count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    ).unpivot([], ["count", "null_count", "mean", "std", "min", "max"], "statistic", "value")

    def nearest(q: float) -> Column:
        return F.floor((F.col("_total") - 1) * F.lit(q) + F.lit(0.5)).cast("bigint") + 1

    ranked = values_at_ranks(df, column, [nearest(q) for q in QUARTILES], partitions)
    named = F.array(*[F.lit(f"{int(q * 100)}%") for q in QUARTILES])
    quartiles = ranked.select(
        F.element_at(named, F.col("position") + 1).alias("statistic"),
        F.col(column).cast("double").alias("value"),
    )
    return base.unionByName(quartiles)


def dataset_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of equal values per column over the pairs of rows that share a key.

    Null equals nothing, as in an SQL comparison. Where the sides differ in type, ``b`` is cast to
    the type of ``a``, and a value that does not fit is null. The pairs of a key are joined and compared
    if they are no more than the values its rows hold. For the other keys, repeated often on both
    sides, the pairs are not built: the pairs that agree on a value are the product of the two
    sides' counts of it. So the work never exceeds that of counting every value. Products are
    summed as decimals, since two counts of some billions overflow a long.

    Rows are counted by key first, which reads the keys alone, and the counts are written once. The
    joins are ones of plain shuffles, which adaptive execution can split where a key is hot.
    """
    keys = [k for k in keys if k in a.columns and k in b.columns]
    columns = [c for c in a.columns if c in b.columns and c not in keys]
    held, wanted = ({f.name: f.dataType for f in df.schema.fields} for df in (b, a))
    a = a.select(*keys, *columns).dropna(subset=keys)
    b = b.select(
        *[
            F.col(c) if held[c] == wanted[c] else fit(F.col(c), held[c], wanted[c]).alias(c)
            for c in (*keys, *columns)
        ]
    ).dropna(subset=keys)
    left, right = F.col("_side") == 0, F.col("_side") == 1
    both = a.select("*", F.lit(0).alias("_side")).unionByName(b.select("*", F.lit(1).alias("_side")))
    per_key = stage(
        both.groupBy(*keys)
        .agg(F.count_if(left).alias("_na"), F.count_if(right).alias("_nb"))
        .where("_na > 0 AND _nb > 0"),
        "diff-keys",
    )
    pairs = F.col("_na").cast("decimal(19,0)") * F.col("_nb").cast("decimal(19,0)")
    values = (F.col("_na") + F.col("_nb")) * F.lit(len(columns))
    repeated = per_key.where(pairs > values).select(*[F.col(k).alias(f"_k{k}") for k in keys])
    total = per_key.agg(F.coalesce(F.sum(pairs), F.lit(0)).cast("decimal(38,0)").alias("_pairs"))
    some_repeated = not repeated.isEmpty()
    few = a
    if some_repeated:
        few = a.join(repeated, [a[k] == repeated[f"_k{k}"] for k in keys], "left_anti")
    others = b.select(*[F.col(c).alias(f"_b{c}") for c in (*keys, *columns)])
    direct = few.join(others, [few[k] == others[f"_b{k}"] for k in keys]).agg(
        *[F.count_if(F.col(c) == F.col(f"_b{c}")).alias(f"e{i}") for i, c in enumerate(columns)]
    )
    direct_rows = total.crossJoin(direct).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col("_pairs").alias("pairs"),
                        F.col(f"e{i}").cast("decimal(38,0)").alias("equal"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    found = [direct_rows]
    if some_repeated:
        on = [both[k] == repeated[f"_k{k}"] for k in keys]
        floating = {f.name for f in both.schema if f.dataType.typeName() in ("float", "double")}
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    # Adding 0.0 turns a negative zero into the zero it equals.
                    (F.col(c) + F.lit(0.0) if c in floating else F.col(c)).cast("string").alias("v"),
                )
                for c in columns
            ]
        )
        per_value = (
            both.join(repeated, on, "left_semi")
            .select(*keys, "_side", F.explode(cells).alias("cell"))
            .select(*keys, "_side", "cell.column", "cell.v")
            .where(F.col("v").isNotNull())
            .groupBy(*keys, "column", "v")
            .agg(F.count_if(left).alias("_na"), F.count_if(right).alias("_nb"))
        )
        found.append(
            per_value.groupBy("column").agg(
                F.lit(0).cast("decimal(38,0)").alias("pairs"),
                F.sum(pairs).cast("decimal(38,0)").alias("equal"),
            )
        )
    totals = (
        reduce(DataFrame.unionByName, found)
        .groupBy("column")
        .agg(
            F.sum("pairs").cast("decimal(38,0)").alias("_pairs"),
            F.sum("equal").cast("decimal(38,0)").alias("equal"),
        )
    )
    return totals.select(
        "column",
        "equal",
        (F.col("_pairs") - F.col("equal")).cast("decimal(38,0)").alias("different"),
        percent(F.col("equal"), F.col("_pairs")).alias("percent_equal"),
    ).orderBy(F.desc("percent_equal"), F.asc("column"))
