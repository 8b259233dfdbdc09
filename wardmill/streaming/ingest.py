"""Incremental cleaning: each run takes the files that have arrived since the last one.

The stream is one of files, not of rows: what a batch brings is the list of its files, which are then
read as a batch reads them, each with the columns and types it has. A batch writes a folder named by
its number. If a run breaks off, the stream gives the same files under the same number again, and the
folder is replaced, so no row is lost and none is there twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardmill.operators.standing import StandingContraction
from wardmill.plans.records import COLUMNS, treat
from wardmill.sinks.writers import COMPRESSION
from wardmill.sources.files import exists, read_drifting

FILES_PER_BATCH = 4096  # paths that the driver holds at once
FILES = "_files"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A stream of the files below ``folder`` as (path, length); contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_batch)
        .load(folder)
        .select("path", "length")
    )


def each_batch(
    files: DataFrame, checkpoint: str, take: Callable[[DataFrame, list[str], int], None],
    columns: Sequence[str] = COLUMNS,
) -> StreamingQuery:
    """Call ``take(rows, skipped, number)`` for each batch of files, then stop.

    ``rows`` is the union of the readable files as text, None if there is none.
    """

    def run(batch: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in batch.select("path").collect())  # at most per_batch
        if not paths:
            return
        try:
            ingest = read_drifting(batch.sparkSession, paths, columns)
        except FileNotFoundError:
            take(None, paths, number)
        else:
            take(ingest.rows, ingest.skipped, number)

    return (
        files.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_new_files(
    spark: SparkSession, folder: str, out: str, checkpoint: str,
    columns: Sequence[str] = COLUMNS, transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Append ``transform`` of every file not yet ingested to the table ``out``, then stop.

    Rows carry the number of their ``batch``. Files without a readable footer are listed in
    ``left_out``.
    """

    def take(rows: DataFrame | None, skipped: list[str], number: int) -> None:
        if rows is not None:
            _replace(transform(rows), f"{out}/batch={number}")
        if skipped:
            listed = spark.createDataFrame([(p,) for p in skipped], "path string")
            _replace(listed, f"{out}/{FILES}/batch={number}")

    files = arriving_files(spark, folder, per_batch=files_per_batch)
    return each_batch(files, checkpoint, take, columns)


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def left_out(spark: SparkSession, out: str) -> DataFrame:
    """``path`` and ``batch`` of the files that could not be read."""
    if not exists(spark, f"{out}/{FILES}"):
        return spark.createDataFrame([], "path string, batch int")
    return spark.read.parquet(f"{out}/{FILES}").select("path", F.col("batch").cast("int"))


def treat_new_files(
    spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH
) -> StreamingQuery:
    """Clean every file not yet ingested, append the result, then stop."""
    return ingest_new_files(spark, folder, out, checkpoint, COLUMNS, treat, files_per_batch)


def contract_new_files(
    spark: SparkSession, folder: str, standing: StandingContraction, checkpoint: str,
    columns: Sequence[str] = COLUMNS, transform: Callable[[DataFrame], DataFrame] = treat,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Merge every file not yet ingested into a standing contraction, then stop.

    The number of the batch is committed with its states, so a batch that is given again is not
    counted again.
    """

    def take(rows: DataFrame | None, skipped: list[str], number: int) -> None:
        if rows is not None:
            standing.load(transform(rows), number, source=folder)

    return each_batch(arriving_files(spark, folder, per_batch=files_per_batch), checkpoint, take, columns)
