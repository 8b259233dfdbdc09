"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE sizes the shuffles at run time, splits skewed join
# partitions and turns a join into a broadcast once the side has been measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The JVM leaves methods over 8000 bytes uncompiled. Cleaning 46 columns in one fused stage
    # makes such methods; past this limit Spark uses its split-up projections instead, which
    # halves the time.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A row group or so for each task. Contracting sorts the wide rows of a task by their key, which
    # stays in memory for a million rows and is spilled whole for several.
    "spark.sql.files.maxPartitionBytes": "16m",
}
# Those of them that wide plans need in a session made elsewhere as well.
WIDE = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes")


def build_session(app_name: str = "wardmill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> None:
    """Give a session made elsewhere the settings of wide plans; what it has set itself stays."""
    for key in WIDE:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, SETTINGS[key])


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own. On a
    cluster a machine-local folder would be lost with its executor, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="wardmill-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/wardmill-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; ``drop_staged`` removes what is written there."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back, which cuts the lineage.

    A written table keeps column pruning for its readers and survives lost executors. The
    tables of one application share a folder; ``drop_staged`` removes it once what depends on
    them has been written.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
