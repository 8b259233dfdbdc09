"""Key operators: orphans, set difference, referential cleanup, ranks over the whole table.

Keys are counted before they are joined. A key that holds a third of the child rows then
enters the join as one row, and no join output grows with the number of duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.session import stage


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def orphan_counts(
    child: DataFrame,
    fk: str | Sequence[str],
    parent: DataFrame,
    pk: str | Sequence[str],
    count_name: str = "occurrences",
) -> DataFrame:
    """Child key values without a parent, with their number of rows; null keys are ignored.

    Both sides enter the join aggregated by key, on the partitioning the join needs.
    """
    fk, pk = _names(fk), _names(pk)
    counted = (
        child.select(*fk).dropna(how="any").groupBy(*fk).agg(F.count("*").alias(count_name))
    )
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]).distinct()
    on = [counted[f] == parents[f"_p{i}"] for i, f in enumerate(fk)]
    return counted.join(parents, on, "left_anti")


def orphan_keys(
    child: DataFrame, fk: str | Sequence[str], parent: DataFrame, pk: str | Sequence[str]
) -> DataFrame:
    """Distinct child key values without a parent."""
    return orphan_counts(child, fk, parent, pk).select(*_names(fk))


def orphan_frequency(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, n: int, count_name: str
) -> DataFrame:
    """The ``n`` most frequent orphan values, ties by value."""
    counts = orphan_counts(child, fk, parent, pk, count_name)
    return counts.orderBy(F.desc(count_name), F.asc(fk)).limit(n)


def keep_children(
    child: DataFrame, fk: str | Sequence[str], parent: DataFrame, pk: str | Sequence[str]
) -> DataFrame:
    """Child rows whose parent still exists (what ``ON DELETE CASCADE`` leaves).

    Parent keys are unique. Whole child rows are joined, so a hot key is left to adaptive
    execution, which splits its partition; that needs plain shuffles under the join.
    """
    fk, pk = _names(fk), _names(pk)
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)])
    return child.join(parents, [child[f] == parents[f"_p{i}"] for i, f in enumerate(fk)], "left_semi")


def missing_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks, null being equal to null; empty means subset."""
    return a.distinct().subtract(b.distinct())


def new_keys(listed: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Listed entries whose key is not present yet; repeats of a present key are dropped first."""
    return listed.join(present.select(key).distinct(), key, "left_anti")


def _partition_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """Rows before each range partition and in all: one row per partition, so one for each task.

    Written, so that Spark knows how small it is and need not shuffle what it is joined with.
    """
    sizes = placed.groupBy("_part").agg(size.alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    return stage(offsets, "offsets")


def number_rows(
    df: DataFrame,
    name: str,
    order: Sequence[str] = (),
    partitions: int | None = None,
    total: bool = False,
) -> DataFrame:
    """Gap-free ids 1..n without moving the table through one task.

    Rows are numbered where they are: each partition counts its own rows, the numbered rows are
    written once so that the numbers stay, and a partition starts after the sizes before it.

    With ``order`` the rows are range-partitioned and sorted first. Equal rows are told apart by
    a written position, so that many copies of one row are still split over partitions, and
    split the same way if a task is run again. A caller that knows its order to be ``total``, no
    two rows being equal in it, saves that first write.
    """
    columns = df.columns
    if order:
        tied, by = df, list(order)
        if not total:
            tied = stage(df.select("*", F.monotonically_increasing_id().alias("_tie")), "tied")
            by.append("_tie")
        ranged = (
            tied.repartitionByRange(partitions, *by) if partitions else tied.repartitionByRange(*by)
        )
        df = ranged.sortWithinPartitions(*by)
    # The id holds the partition number above its lower 33 bits.
    position = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
    placed = stage(
        df.select(*columns, F.spark_partition_id().alias("_part"), position.alias("_pos")),
        "numbered",
    )
    offsets = _partition_offsets(placed, F.count("*"))
    joined = placed.join(offsets, "_part")
    return joined.select(
        (F.col("_before") + F.col("_pos") + 1).cast("bigint").alias(name), *columns
    )


def values_at_ranks(
    df: DataFrame, column: str, ranks: Sequence[Column], partitions: int | None = None
) -> DataFrame:
    """Exact order statistics of the non-null values as rows (``position``, value).

    ``ranks`` are 1-based ranks over ``_total``; ``position`` tells which of them a row answers.
    Equal values are counted first, so a value that fills the table is a single row; the
    distinct values are range-partitioned and the running count is taken per partition.
    """
    counted = (
        df.select(column)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_n"))
    )
    ranged = (
        counted.repartitionByRange(partitions, column)
        if partitions
        else counted.repartitionByRange(column)
    )
    placed = stage(ranged.select("*", F.spark_partition_id().alias("_part")), "ranked")
    offsets = _partition_offsets(placed, F.sum("_n"))
    in_part = (
        Window.partitionBy("_part").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    )
    running = placed.join(offsets, "_part").select(
        column, "_n", "_total", (F.col("_before") + F.sum("_n").over(in_part)).alias("_upto")
    )
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n")), F.lit(i)
                )
                for i, r in enumerate(ranks)
            ]
        )
    )
    return running.select(F.explode(hits).alias("position"), column)
