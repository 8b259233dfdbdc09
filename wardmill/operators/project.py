"""Projections: canonical columns, declared types, union of drifting frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.functions.numeric import fit


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Replace the named columns where present, in one projection."""
    return df.select(*[rules[c].alias(c) if c in rules else F.col(c) for c in df.columns])


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that are absent; present ones are left alone."""
    missing = [value.alias(name) for name, value in defaults.items() if name not in df.columns]
    return df.select("*", *missing) if missing else df


def text_of(c: Column, held: T.DataType) -> Column:
    """A raw value as text, by its type.

    Floats and doubles are written out plainly, to 12 decimals: whole ones without a point, so that
    an integer column that a writer stored as double keeps its values, and small ones without an
    exponent. What is no number (NaN, infinity) or has over 38 digits is null. Decimals are exact
    and print plainly as they are.
    """
    if not isinstance(held, (T.FloatType, T.DoubleType)):
        return c.cast("string")
    text = c.cast("string")
    plain = text.try_cast("decimal(38,12)").cast("string")
    short = F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")
    return F.coalesce(short, text.try_cast("decimal(38,0)").cast("string"))


def as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Canonical text projection: missing columns become null, others are dropped."""
    held = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (text_of(F.col(c), held[c]) if c in held else F.lit(None).cast("string")).alias(c)
            for c in columns
        ]
    )


def union_as_text(frames: Iterable[DataFrame], columns: Iterable[str]) -> DataFrame:
    """UNION ALL of frames whose columns and types differ, under one text schema."""
    columns = list(columns)
    return reduce(DataFrame.unionByName, [as_text(frame, columns) for frame in frames])


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = False) -> DataFrame:
    """Keep the declared columns and cast them; a value that does not fit becomes null.

    With ``fill_missing`` the declared columns the frame lacks are added as null.
    """
    present = set(df.columns)
    out = []
    for field in schema.fields:
        if field.name in present:
            held = df.schema[field.name].dataType
            out.append(fit(F.col(field.name), held, field.dataType).alias(field.name))
        elif fill_missing:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def extra_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns ``conform`` leaves out."""
    declared = set(schema.fieldNames())
    return [c for c in df.columns if c not in declared]
