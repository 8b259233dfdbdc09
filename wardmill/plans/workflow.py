"""The stages in order: unify, treat, contract, split, load, audit.

Every stage writes its table once and the next one reads it; the 16 star tables read the
written contracted table with only the columns they need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wardmill.operators.profile import completeness
from wardmill.plans.audit import audit, declared_checks, key_checks, written_checks
from wardmill.plans.model import TABLES, load_order
from wardmill.plans.records import COLUMNS, contract_records, treat, unidentified
from wardmill.plans.star import star_tables
from wardmill.session import drop_staged
from wardmill.sinks.snapshot import Store
from wardmill.sinks.writers import (
    load_all,
    load_snapshot,
    read_version,
    write_csv,
    write_parquet,
    write_version,
)
from wardmill.sources.files import convert_lookups, discover, exists, read_drifting

# The lookup tables that come as CSV files.
LOOKUPS = ("cid10", "municipios", "procedimentos", "indicadores")


@dataclass(frozen=True)
class Layout:
    """Where the stages keep their tables."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def support(self) -> str:
        return f"{self.root}/support"

    @property
    def unified(self) -> str:
        return f"{self.root}/interim/unified"

    @property
    def treated(self) -> str:
        return f"{self.root}/interim/treated"

    @property
    def contracted(self) -> str:
        return f"{self.root}/interim/contracted"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed"

    @property
    def loaded(self) -> str:
        return f"{self.root}/loaded"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


def unify(spark: SparkSession, at: Layout, columns: Sequence[str] = COLUMNS) -> dict:
    paths = [row.path for row in discover(spark, at.raw).select("path").toLocalIterator()]
    ingest = read_drifting(spark, paths, columns)
    rows = write_parquet(ingest.rows, at.unified)
    return {"rows": rows, "files": len(ingest.read), "skipped": ingest.skipped}


def report_stage(spark: SparkSession, at: Layout) -> int:
    """Completeness by column, and the records whose id cannot be read; returns how many."""
    unified = spark.read.parquet(at.unified)
    write_csv(completeness(unified), f"{at.reports}/completeness", single_file=True)
    return write_parquet(unidentified(unified), f"{at.reports}/unidentified")


def treat_stage(spark: SparkSession, at: Layout) -> str:
    return write_version(treat(spark.read.parquet(at.unified)), at.treated)


def contract_stage(spark: SparkSession, at: Layout) -> int:
    return write_parquet(contract_records(read_version(spark, at.treated)), at.contracted)


def split_stage(spark: SparkSession, at: Layout) -> dict[str, int]:
    sources = {name: f"{at.support}/{name}.csv" for name in LOOKUPS}
    schemas = {name: TABLES[name].schema for name in LOOKUPS}
    convert_lookups(spark, sources, schemas, at.processed)
    tables = star_tables(read_version(spark, at.treated), spark.read.parquet(at.contracted))
    return {name: write_parquet(df, f"{at.processed}/{name}") for name, df in tables.items()}


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.parquet(f"{folder}/{name}")
        for name in load_order()
        if exists(spark, f"{folder}/{name}")
    }


def load_stage(spark: SparkSession, at: Layout, write=None) -> dict[str, int]:
    """Load all tables as one snapshot, or one after the other by ``write``."""
    tables = read_tables(spark, at.processed)
    return load_all(tables, write) if write else load_snapshot(tables, Store(spark, at.loaded))


def audit_stage(spark: SparkSession, at: Layout) -> DataFrame:
    """Checks on the tables of the latest snapshot."""
    tables = Store(spark, at.loaded).tables()
    return audit(tables, declared_checks() + written_checks() + key_checks())


def run_all(spark: SparkSession, at: Layout) -> Mapping[str, object]:
    """Every stage once; returns what each reports."""
    out: dict[str, object] = {"unify": unify(spark, at)}
    out["unidentified"] = report_stage(spark, at)
    out["treat"] = treat_stage(spark, at)
    out["contract"] = contract_stage(spark, at)
    out["split"] = split_stage(spark, at)
    out["load"] = load_stage(spark, at)
    drop_staged(spark)  # what was staged has been loaded
    out["audit"] = audit_stage(spark, at)
    return out
