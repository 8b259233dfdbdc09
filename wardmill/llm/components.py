"""Connected components of a link table, without links or components on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.session import stage


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node with the smallest it is linked to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 65536):
        part = nodes[i : i + 65536]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["u", "v"]
        )


def _stars(links: DataFrame) -> DataFrame:
    """One round: larger neighbours, then smaller ones, are linked to the smallest neighbour.

    The smallest is aggregated before it is joined, so a node with many links stays many rows
    that a skewed join can split.
    """
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u > v").distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every linked node but that one.

    ``links`` has two long columns. Links of a task are contracted by union-find, then rounds of
    stars follow until nothing changes; each round is written, so none is computed twice.
    """
    u, v = links.columns
    now = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v")
    now = stage(now.mapInArrow(_forest, "u long, v long").distinct(), "components")
    mark = None
    while True:
        sums = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(sums) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(sums)
        now = stage(_stars(now), "components")
