"""Satellite extraction: cast, filter, project, remove duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.operators.contract import dedup_first
from wardmill.operators.project import apply_rules


@dataclass(frozen=True)
class Satellite:
    """What to take out of the contracted table.

    ``rules`` replace columns before ``where`` is applied; the columns it reads need not be
    kept. ``dedup`` is ``first`` (one row per key), ``rows`` (distinct rows) or ``none``.
    """

    table: str
    columns: tuple[str, ...]
    where: Column | None = None
    rules: Mapping[str, Column] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    dedup: str = "none"
    order: tuple[str | Column, ...] = ()


def extract(df: DataFrame, spec: Satellite, unique_on: Sequence[str] | None = None) -> DataFrame:
    """Run one extraction.

    ``unique_on`` states the columns ``df`` is already unique on; a satellite that keeps them
    cannot hold duplicates, and its shuffle is left out.
    """
    rows = apply_rules(df, spec.rules)
    if spec.where is not None:
        rows = rows.where(spec.where)
    out = rows.select(*spec.columns)
    if unique_on and set(unique_on) <= set(spec.columns):
        return out
    if spec.dedup == "first":
        return dedup_first(out, spec.key, spec.order)
    if spec.dedup == "rows":
        return out.distinct()
    return out


def valid_code(c: Column, invalid: Sequence[str] = ("00",)) -> Column:
    return c.isNotNull() & ~c.isin(*invalid)


def unpivot_codes(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name_column: str,
    value_column: str,
    invalid: Sequence[str] = ("00",),
) -> DataFrame:
    """Wide to long, keeping valid codes only.

    Rows with no valid code are dropped before the rows are multiplied.
    """
    any_valid = reduce(or_, [valid_code(F.col(v), invalid) for v in values])
    long = df.where(any_valid).unpivot(list(ids), list(values), name_column, value_column)
    return long.where(valid_code(F.col(value_column), invalid))


def mode_dimension(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Most frequent value of each attribute per key; the smallest of equally frequent ones.

    Rows are first counted per (key, all attributes), which collapses a key that holds much of
    the table before anything is shuffled. Only those counts are unfolded by attribute.
    """
    combos = df.groupBy(key, *attributes).agg(F.count("*").alias("_n"))
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("at"),
                *[
                    (F.col(a) if a == name else F.lit(None).cast(df.schema[a].dataType)).alias(a)
                    for a in attributes
                ],
            )
            for i, name in enumerate(attributes)
        ]
    )
    per_value = (
        combos.select(key, "_n", F.explode(cells).alias("cell"))
        .groupBy(key, "cell.at", *[F.col(f"cell.{a}").alias(a) for a in attributes])
        .agg(F.sum("_n").alias("_n"))
    )
    best = []
    for i, name in enumerate(attributes):
        mine = (F.col("at") == i) & F.col(name).isNotNull()
        best.append(
            F.min(F.when(mine, F.struct((-F.col("_n")).alias("n"), F.col(name).alias("v")))).alias(
                name
            )
        )
    picked = per_value.groupBy(key).agg(*best)
    return picked.select(key, *[F.col(f"{a}.v").alias(a) for a in attributes])

