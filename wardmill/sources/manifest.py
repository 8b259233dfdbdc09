"""Which inputs are expected, present and still to be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.operators.keys import new_keys

# Months of a year.
MONTHS = tuple(range(1, 13))


def new_files(listed: DataFrame, present: DataFrame) -> DataFrame:
    """Listed files whose stem has no non-empty file yet. Both come from ``discover``."""
    return new_keys(listed, present.where("length > 0"), "stem")


def expected_grid(
    units: DataFrame, first_year: Column | int, last_year: Column | int, months: Sequence[int] = ()
) -> DataFrame:
    """One row per unit and year (and month), made row by row, without a join."""
    low = first_year if isinstance(first_year, Column) else F.lit(first_year)
    high = last_year if isinstance(last_year, Column) else F.lit(last_year)
    grid = units.select("*", F.explode(F.sequence(low, high)).alias("year"))
    if months:
        grid = grid.select("*", F.explode(F.array(*[F.lit(m) for m in months])).alias("month"))
    return grid


def coverage_gaps(grid: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected periods with no data."""
    return grid.join(present.select(*on).distinct(), list(on), "left_anti")
