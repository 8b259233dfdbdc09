"""Parquet, CSV, versioned, catalog and JDBC sinks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.keys import number_rows
from wardmill.operators.project import conform
from wardmill.plans.model import CASE, TABLES, load_order, relational_columns
from wardmill.sinks.snapshot import Store

COMPRESSION = "snappy"
POINTER = "_versions"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: tuple = ()) -> int:
    """Write a parquet table and return its row count, observed while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).option("compression", COMPRESSION).partitionBy(*by).parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. ``single_file`` is for reports, whose size is the column count."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_version(df: DataFrame, path: str, version: str | None = None) -> str:
    """Write a new version beside the earlier ones, then point to it.

    Readers follow the pointer, which is only added once the data is complete; earlier versions
    stay as backups.
    """
    version = version or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    spark = df.sparkSession
    write_parquet(df, f"{path}/version={version}", mode="errorifexists")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(
        f"{path}/{POINTER}"
    )
    return version


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    try:
        log = spark.read.schema("version string").json(f"{path}/{POINTER}")
    except AnalysisException:
        return []
    return [row.version for row in log.distinct().orderBy("version").collect()]


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The latest version, or the one named."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/version={version or known[-1]}")


def prepare(df: DataFrame, table: str) -> DataFrame:
    """Rows in the declared columns and types, with the generated id where there is one."""
    spec = TABLES[table]
    if spec.generated_id and spec.generated_id not in df.columns:
        df = number_rows(df, spec.generated_id)
    return conform(df, spec.schema, fill_missing=True)


def load_all(tables: Mapping[str, DataFrame], write) -> dict[str, int]:
    """Full refresh in reference order; ``write(name, rows)`` replaces a table, returns its size.

    An empty input leaves the table as it is, unless a table it refers to was replaced: its old
    rows would then refer to rows that are gone, so it is replaced by an empty one.
    """
    loaded = {}
    for name in load_order(tables):
        parents = {r.to_table for r in TABLES[name].references}
        if tables[name].isEmpty() and not parents & loaded.keys():
            continue
        loaded[name] = write(name, prepare(tables[name], name))
    return loaded


def parquet_writer(root: str):
    return lambda name, df: write_parquet(df, f"{root}/{name}")


def load_snapshot(tables: Mapping[str, DataFrame], store: Store) -> dict[str, int]:
    """Full refresh of all tables at once: readers of ``store`` see all old ones or all new ones.

    Every table is written beside the old one; the last step makes a version that names them.
    Tables that ``load_all`` leaves alone keep their folder.
    """
    before = store.read()
    parts: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> int:
        parts[name] = store.new_folder(name)
        return write_parquet(df, f"{store.root}/{parts[name]}", mode="errorifexists")

    loaded = load_all(tables, write)
    if parts:
        store.commit(before, parts)
    return loaded


def catalog_writer(database: str, buckets: int | None = None):
    """Managed tables of a catalog database.

    With ``buckets``, tables that are unique on the case id are bucketed by it, so that their
    key checks and joins need no shuffle. Tables that repeat an id are not: one bucket would
    have to hold every row of a hot id.
    """

    def write(name: str, df: DataFrame) -> int:
        seen = Observation()
        bucketed = buckets and TABLES[name].primary_key == (CASE,)
        if bucketed:  # one file for each bucket, not one for each task and bucket
            df = df.repartition(buckets, CASE)
        writer = (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .format("parquet")
            .option("compression", COMPRESSION)
        )
        if bucketed:
            writer = writer.bucketBy(buckets, CASE).sortBy(CASE)
        writer.saveAsTable(f"{database}.{name}")
        return seen.get["rows"]

    return write


def jdbc_writer(url: str, options: Mapping[str, str] | None = None):
    """Truncate and append over JDBC, keeping the target's definition."""

    def write(name: str, df: DataFrame) -> int:
        seen = Observation()
        writer = (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .format("jdbc")
            .option("url", url)
            .option("dbtable", name)
            .option("truncate", "true")
            .option("cascadeTruncate", "true")
            .option("createTableColumnTypes", relational_columns(TABLES[name]))
        )
        for key, value in (options or {}).items():
            writer = writer.option(key, value)
        writer.save()
        return seen.get["rows"]

    return write


def table_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def with_total(counts: DataFrame) -> DataFrame:
    """The counts and their sum over all tables."""
    total = counts.agg(F.sum("rows").alias("rows")).select(
        F.lit("total").alias("table_name"), "rows"
    )
    return counts.unionByName(total)
