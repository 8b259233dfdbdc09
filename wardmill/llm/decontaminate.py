"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Words are runs of letters and digits, lowered; in scripts that put no blanks between words each
character is one. A seed hashes the words that a fixed mask selects
from a window and ignores the others, so replaced words between them do not matter. Seeds of all
documents are joined with those of the benchmark; each hit sets a document and an item side by
side at one offset. There, equal words are counted position by position, and the document holds
the item if ``share`` of some ``window`` consecutive words agree (of all words, if the item has
fewer).

The three masks meet every such overlap: by trial of all patterns, each way to replace 4 of 20,
3 of 15, 2 of 12 or 10, or 1 of 8 words leaves at least one of them a window free of it. Items of
fewer than ``LEAST`` words are found where they stand word for word, by one key of all their words.

Defined results: null texts and those without words match nothing; equal items are found each;
repeated rows are one document; documents of any length are searched whole; an empty table gives
no rows; extra columns are ignored, and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import keyed, let, same_document
from wardmill.session import stage

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
SPAN = 8
LEAST = 8
# Blocks of scripts without blanks (Thai, Lao, Burmese, Khmer, kana, Han).
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
WORD = rf"[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+|[{UNSPACED}&&[\p{{L}}\p{{N}}\p{{M}}]]"
WINDOW, SHARE = 20, 0.8
BROADCAST_SEEDS = 1_000_000  # at most, 24 bytes each; more are joined by a shuffle


def _hashes(text: Column) -> Column:
    """Hashes of a text's words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.transform(found, lambda word: F.xxhash64(word))


def _whole_key(values: list[Column]) -> Column:
    """Key of a sequence of fewer than ``LEAST`` words."""
    return F.xxhash64(F.lit(-len(values)), *values)


def _seeds(df: DataFrame, short: list[int], *carried: str) -> DataFrame:
    """Rows (``key``, ``pos``) of all masks at all positions of the ``hashes`` of ``df``.

    Also the keys of all sequences whose length is one of ``short``.
    """
    shifted = [
        F.slice("hashes", o + 1, F.greatest(F.size("hashes") - o, F.lit(0))).alias(f"w{o}")
        for o in range(SPAN)
    ]
    at = df.select(*carried, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "w"))

    def key(last: int, value: Column) -> Column:
        return F.when(F.col(f"w.w{last}").isNotNull(), value)

    keys = [
        key(mask[-1], F.xxhash64(F.lit(i), *[F.col(f"w.w{o}") for o in mask]))
        for i, mask in enumerate(MASKS)
    ]
    keys += [key(n - 1, _whole_key([F.col(f"w.w{o}") for o in range(n)])) for n in short]
    return at.select(*carried, "pos", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")


def _item_seeds(items: DataFrame, short: list[int]) -> DataFrame:
    """Rows (``item``, ``item_pos``, ``key``): of each short item its whole, of others all masks."""
    seeds = _seeds(items.where(F.size("hashes") >= LEAST), [], "item")
    for n in short:
        whole = _whole_key([F.get("hashes", F.lit(o)) for o in range(n)])
        own = items.where(F.size("hashes") == n)
        seeds = seeds.union(own.select("item", F.lit(0).alias("pos"), whole.alias("key")))
    return seeds.withColumnRenamed("pos", "item_pos")


def _best(a: Column, b: Column, start: Column, window: int) -> Column:
    """Most equal words in a window of ``b`` laid over ``a`` from ``start``, and where they lie."""
    first = F.greatest(F.lit(0), -start)
    length = F.least(F.size(b), F.size(a) - start) - first
    size = F.least(F.size(b), F.lit(window))
    equal = F.zip_with(
        F.slice(a, start + first + 1, length),
        F.slice(b, first + 1, length),
        lambda x, y: (x == y).cast("int"),
    )

    def most(e: Column) -> Column:
        def in_window(i: Column) -> Column:
            run = F.slice(e, i + 1, size)
            return F.aggregate(run, F.lit(0), lambda total, x: total + x)

        return F.when(
            length >= size,
            F.struct(
                F.array_max(F.transform(F.sequence(F.lit(0), length - size), in_window)).alias("best"),
                F.aggregate(e, F.lit(0), lambda total, x: total + x).alias("equal"),
                (start + first).alias("doc_start"),
                length.alias("overlap"),
            ),
        )

    return F.when(length > 0, let(equal, most))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE
) -> DataFrame:
    """One row per document, item and offset that overlap enough.

    ``id``, ``digest``, ``item_id``, ``doc_start`` (word of the document), ``overlap`` (words laid
    side by side), ``equal`` (of them), ``best`` (equal words in the best window).
    """
    items = stage(
        benchmark.select("item_id", _hashes(F.coalesce("text", F.lit(""))).alias("hashes"))
        .where(F.size("hashes") > 0)
        .withColumn("item", F.xxhash64("item_id", "hashes"))
        .dropDuplicates(["item"]),
        "bench-items",
    )
    sizes = items.where(F.size("hashes") < LEAST).select(F.size("hashes")).distinct()
    short = sorted(n for (n,) in sizes.collect())  # fewer than LEAST
    seeds = _item_seeds(items, short)
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    whole = keyed(docs).select("id", "digest", "body")
    hits = stage(
        _seeds(whole.select("id", "digest", _hashes(F.col("body")).alias("hashes")), short, "id", "digest")
        .join(seeds, "key")
        .select("id", "digest", "item", (F.col("pos") - F.col("item_pos")).alias("start"))
        .distinct(),
        "bench-hits",
    )
    # All offsets of an item in a document together, so that its words are read once for them.
    offsets = hits.groupBy("id", "digest", "item").agg(F.collect_list("start").alias("starts"))
    found = whole.join(offsets, same_document(whole, offsets)).select(
        whole["id"], whole["digest"], "item", "starts", _hashes(F.col("body")).alias("words")
    )
    laid = found.join(items, "item").select(
        "id", "digest", "item_id", F.size("hashes").alias("item_words"),
        F.explode(
            let(
                F.struct("words", "hashes"),
                lambda s: F.transform(
                    F.col("starts"), lambda start: _best(s["words"], s["hashes"], start, window)
                ),
            )
        ).alias("laid"),
    )
    part = F.ceil(F.least("item_words", F.lit(window)) * F.lit(share).cast("decimal(9,6)"))
    needed = F.when(F.col("item_words") < LEAST, F.col("item_words")).otherwise(part)
    return (
        laid.where(F.col("laid.best") >= needed)
        .select("id", "digest", "item_id", "laid.doc_start", "laid.overlap", "laid.equal", "laid.best")
        .distinct()
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, unchanged."""
    whole = keyed(docs)
    found = contaminated(docs, benchmark).select("id", "digest").distinct()
    return whole.join(found, same_document(whole, found), "left_anti").select("row.*")
