"""Relational reads with the projection and the null filter pushed to the source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A table over JDBC; with ``split_on`` it is read in parallel key ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if split_on and bounds and partitions:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def known_values(table: DataFrame, column: str) -> DataFrame:
    """The non-null values of one column; projection and filter reach the source."""
    return table.select(column).where(F.col(column).isNotNull())
