"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmill.llm import decontaminate, line_dedup, mix, near_dedup, quality
from wardmill.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; those with no line left go."""
    return line_dedup.dedup(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.dedup(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: ``texts`` holds what each document gives, repeats included.

    One row per document, also if it gives nothing; the lists together are the mixed corpus.
    """
    plan = stage(mix.mix(docs), "mix-plan")
    return mix.given(docs, plan).drop("digest")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", distinct_lines),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mixed),
]

# The classifier's trees cannot be put into SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
