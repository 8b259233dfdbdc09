"""Parquet and CSV sources whose files drift in schema or may be unreadable."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmill.operators.project import as_text

FOOTERS_PER_TASK = 256
# What Spark calls a path that holds no table.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def discover(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Leaf files below ``root`` as (path, length, stem), each once, by path.

    Only files are listed, so a folder that is itself named like a file is not read twice.
    File contents are not loaded.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
        .distinct()
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", "length", file_stem(name).alias("stem")).orderBy("path")


def file_stem(name):
    """File name without its extension (and without a doubled ``.dbc``)."""
    return F.regexp_replace(name, r"(\.dbc)?(\.[^.]+)$|\.dbc$", "")


@dataclass(frozen=True)
class Ingest:
    """Unified rows, and the files that were read and left out."""

    rows: DataFrame
    read: list[str]
    skipped: list[str]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each file's columns and types as text, null if it has no readable parquet footer.

    Whatever else goes wrong, a missing permission or a store that does not answer, is raised.
    """
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as file:
                try:
                    # Only names and types count; other metadata differs between equal schemas.
                    found.append(pq.read_schema(file).remove_metadata().to_string())
                except pa.ArrowInvalid:
                    found.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array(found, pa.string())], ["path", "footer"]
        )


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path`` and ``footer`` of the files, read by tasks in one pass."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = max(1, -(-len(paths) // FOOTERS_PER_TASK))
    return listed.repartition(tasks).mapInArrow(_footers, "path string, footer string")


def read_drifting(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> Ingest:
    """Read files whose columns and types differ into one canonical text table.

    A file without a readable footer is left out and listed; one that breaks off later fails
    the job, so that no rows go missing unseen.

    Footers are read by tasks; the driver gets the paths of each distinct schema. Files with
    equal schemas are read by one scan, so jobs and plan grow with the number of distinct
    schemas and not with the number of files. One scan cannot hold an integer and a text column
    of the same name, hence the grouping.
    """
    grouped = footers(spark, paths).groupBy("footer").agg(F.sort_array(F.collect_list("path")))
    by_schema = {footer: members for footer, members in grouped.collect()}
    skipped = by_schema.pop(None, [])
    if not by_schema:
        raise FileNotFoundError("no readable file among those listed")
    groups = [members for _, members in sorted(by_schema.items())]
    frames = [
        as_text(spark.read.schema(spark.read.parquet(members[0]).schema).parquet(*members), columns)
        for members in groups
    ]
    read = [p for members in groups for p in members]
    return Ingest(reduce(DataFrame.unionByName, frames), sorted(read), skipped)


def unread_files(listed: DataFrame, rows_by_file: DataFrame) -> DataFrame:
    """Listed files that delivered no row; ``rows_by_file`` has a ``path`` column."""
    return listed.join(rows_by_file.select("path"), "path", "left_anti")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count by source file, for a frame that comes straight from a file source."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("rows")
    )


# The lookup files are Latin-1.
LOOKUP_ENCODING = "ISO-8859-1"


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A lookup CSV with header, under its declared schema; None if the file is missing."""
    try:
        return (
            spark.read.schema(schema)
            .option("header", "true")
            .option("encoding", LOOKUP_ENCODING)
            .option("escape", '"')
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table is already at ``path``."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return False


def convert_lookups(
    spark: SparkSession, sources: Mapping[str, str], schemas: Mapping[str, T.StructType], out: str
) -> dict[str, str]:
    """Convert lookup CSVs to parquet; a missing or already converted one is left alone."""
    status = {}
    for name, path in sources.items():
        target = f"{out}/{name}"
        if exists(spark, target):
            status[name] = "present"
            continue
        frame = read_lookup(spark, path, schemas[name])
        if frame is None:
            status[name] = "missing"
            continue
        frame.write.option("compression", "snappy").parquet(target)
        status[name] = "converted"
    return status
