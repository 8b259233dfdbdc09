"""A contraction that is kept up to date: new rows are merged into stored states of their keys.

A state is what a contraction of more rows can be made from: sums, the sum and the number of the
values of each mean, and the first row under the order. Keys are dealt into buckets by their hash.
A load contracts its own rows to states, opens only the buckets that hold its keys, and writes those
anew; all other buckets stay the files they are. One commit makes the load visible, together with the
number of the load, so that a load that is repeated after a failure counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.operators.contract import _FIRST, _ordered_row
from wardmill.session import stage
from wardmill.sinks.snapshot import Snapshot, Store

BUCKETS = 256


@dataclass(frozen=True)
class Contraction:
    """What is contracted, as in ``contract``; ``columns`` are those of the incoming rows."""

    columns: Sequence[str]
    key: Sequence[str]
    sums: Sequence[str] = ()
    means: Sequence[str] = ()
    order: Sequence[str | Column] = ()
    recomputed: Callable[[Sequence[str]], Mapping[str, Column]] = lambda columns: {}

    @property
    def carried(self) -> list[str]:
        plain = {*self.key, *self.sums, *self.means, *self.recomputed(self.columns)}
        return [c for c in self.columns if c not in plain]

    def states(self, rows: DataFrame) -> DataFrame:
        """One state for each key of ``rows``."""
        made = [F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}") for c in self.sums]
        for c in self.means:
            made += [F.sum(F.col(c).cast("double")).alias(f"total_{c}"), F.count(c).alias(f"count_{c}")]
        # also the number of rows, so that there is something to aggregate
        made.append(F.count("*").alias("rows"))
        if self.carried:
            made.append(F.min(_ordered_row(self.order, self.carried)).alias(_FIRST))
        return rows.groupBy(*self.key).agg(*made)

    def merged(self, states: DataFrame) -> DataFrame:
        """One state for each key from several."""
        rest = [c for c in states.columns if c not in {*self.key, _FIRST}]
        made = [F.sum(c).cast(states.schema[c].dataType).alias(c) for c in rest]
        if self.carried:
            made.append(F.min(_FIRST).alias(_FIRST))
        return states.groupBy(*self.key).agg(*made)

    def finished(self, states: DataFrame) -> DataFrame:
        """The contracted rows, as ``contract`` gives them."""
        recomputed = dict(self.recomputed(self.columns))
        flat = states.select(
            *self.key,
            *[F.col(f"sum_{c}").alias(c) for c in self.sums],
            *[
                F.when(F.col(f"count_{c}") > 0, F.col(f"total_{c}") / F.col(f"count_{c}")).alias(c)
                for c in self.means
            ],
            *[F.col(f"{_FIRST}.{c}").alias(c) for c in self.carried],
        )
        names = list(self.columns) + [c for c in recomputed if c not in self.columns]
        return flat.select(*[recomputed[c].alias(c) if c in recomputed else F.col(c) for c in names])


class StandingContraction:
    """States of a contraction below ``root``; the number of buckets is fixed by the first load."""

    def __init__(self, spark: SparkSession, root: str, spec: Contraction, buckets: int = BUCKETS):
        self.store, self.spec, self.buckets = Store(spark, root), spec, buckets

    def _bucketed(self, states: DataFrame) -> DataFrame:
        return states.withColumn("bucket", F.pmod(F.xxhash64(*self.spec.key), F.lit(self.buckets)).cast("int"))

    def _opened(self, snapshot: Snapshot, buckets: Sequence[str]) -> list[DataFrame]:
        """The stored states of some buckets; one read for all of them."""
        paths = [f"{self.store.root}/{snapshot.parts[b]}" for b in buckets if b in snapshot.parts]
        return [self.store.spark.read.parquet(*paths)] if paths else []

    def load(self, rows: DataFrame, number: int | None = None, source: str = "rows") -> list[int]:
        """Merge ``rows``; returns the buckets rewritten, none if this load has been made already.

        Loads of one source are numbered upwards; without a number a load is the next one.
        """
        before = self.store.read()
        done = before.progress.get(source, -1)
        if number is not None and number <= done:
            return []
        new = stage(self._bucketed(self.spec.states(rows.select(*self.spec.columns))), "states")
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
        progress = {source: done + 1 if number is None else number}
        parts = {}
        if touched:
            old = self._opened(before, [str(b) for b in touched])
            fresh = new.drop("bucket")
            states = self.spec.merged(reduce(DataFrame.unionByName, old, fresh)) if old else fresh
            folder = self.store.new_folder("states")
            (
                self._bucketed(states)
                .repartition(len(touched), "bucket")
                .write.partitionBy("bucket")
                .parquet(f"{self.store.root}/{folder}")
            )
            parts = {str(b): f"{folder}/bucket={b}" for b in touched}
        self.store.commit(before, parts, progress)
        return touched

    def result(self, version: int | None = None) -> DataFrame:
        """All keys contracted, of one version; no row is read twice and none is shuffled."""
        snapshot = self.store.read(version)
        states = self._opened(snapshot, sorted(snapshot.parts, key=int))
        if not states:
            raise FileNotFoundError(f"{self.store.root} has no load yet")
        return self.spec.finished(states[0])
