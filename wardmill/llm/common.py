"""Helpers that the corpus operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.session import stage

# A word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
WORDS_PER_CHUNK = 1 << 17


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def keyed(docs: DataFrame) -> DataFrame:
    """The whole row as ``row``, apart from the columns the operators add, so names can't clash.

    ``id`` and ``digest`` name a document. Repeated rows share both and are treated alike.
    """
    return docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.lit("body"), F.coalesce("text", F.lit(""))).alias("digest"),
        F.coalesce("text", F.lit("")).alias("body"),
    )


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["digest"] == right["digest"])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of ordered pairs."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15 + 2 * salt) + (b ^ np.uint64(0xD1B54A32D192ED03)))


class WordHashes(dict):
    """64-bit hashes of byte words, remembered up to a fixed number of words."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words as UTF-8. ``bytes`` methods know ASCII only, which is what a word is defined by."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def word_chunks(
    texts: list[str | None], hashes: WordHashes, lower: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in chunks of bounded size: index of the first, word hashes, words of each text."""
    first, flat, lengths = 0, [], []
    for i, text in enumerate(texts):
        found = split_words(text, lower)
        flat.extend([hashes[w] for w in found])
        lengths.append(len(found))
        if len(flat) >= WORDS_PER_CHUNK or i == len(texts) - 1:
            yield first, np.array(flat, dtype=np.uint64), np.array(lengths, dtype=np.int64)
            first, flat, lengths = i + 1, [], []


def prefix_sums(
    df: DataFrame, key: list[str], order: list[str], amount: str, label: str
) -> DataFrame:
    """``df`` with ``before``, the sum of ``amount`` over the rows of its key that come before.

    Rows are range-sorted by key and order, each range adds up its own, and the sums of the ranges
    before it are added. So a key of any size is spread over many tasks; what one task sees of a
    key is one row for each range. The ranges are written, so that they and their sums agree even
    if an executor is lost in between. Keys may be null.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*key, *order]]
    ranged = stage(df.repartitionByRange(ranges, *by).withColumn("range", F.spark_partition_id()), label)
    sums = ranged.groupBy(*key, "range").agg(F.sum(amount).alias("sum_"))
    rows_before = Window.unboundedPreceding, -1
    offsets = sums.select(
        F.struct(*key, "range").alias("key_"),
        F.sum("sum_").over(Window.partitionBy(*key).orderBy("range").rowsBetween(*rows_before)).alias("offset_"),
    )
    inside = Window.partitionBy("range", *key).orderBy(*by).rowsBetween(*rows_before)
    placed = ranged.withColumn("inside_", F.sum(amount).over(inside))
    same = [F.col(c).eqNullSafe(F.col(f"key_.{c}")) for c in [*key, "range"]]
    zero = F.lit(0).cast("long")
    return placed.join(offsets, same).select(
        *df.columns,
        (F.coalesce("inside_", zero) + F.coalesce("offset_", zero)).alias("before"),
    )
