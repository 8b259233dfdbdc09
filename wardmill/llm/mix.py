"""Mixing sources to target weights.

Every document gets a hash-random key. The (source, key) pairs are range-sorted, each range sums
its words by source, and the sums of the ranges before turn into prefix sums of words over the
whole source. A source is cut at its exact budget: with target ``T`` and ``S`` words in all it
takes ``floor(T / S)`` whole epochs, and then the documents in key order up to the rest, the last
of them in part. A source of any size is spread over many ranges.

Defined results: null and empty texts have size 0 and none taken; a null source is a source of
its own, after the others; repeated rows are documents of their own, and those with equal ids
share a key, so it does not matter which comes first; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.common import keyed, prefix_sums, same_document, words
from wardmill.session import stage

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
SHARE = 1.5  # of all words, that the sources take together
MOST = 2.0  # times its own size, that a source takes at most


def hash_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target of each source from its ``size``: one row per source.

    Resharing the excess by weight until none is above its limit ends at one level for all open
    sources: ``level * weight``. Sources fill up in order of limit over weight, so running sums in
    that order tell which are full.
    """
    ordered = Window.orderBy(F.col("src").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    known = sizes.withColumn("nth", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.get(listed, F.col("nth") % len(weights))
    )
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "nth")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    )
    opened = known.withColumn("level", left / F.sum("weight").over(after)).withColumn(
        "full", F.col("source_size") * most <= F.col("level") * F.col("weight")
    )
    # The first source that is not full, in filling order, stands at the common level.
    turn = F.struct(F.col("source_size") / F.col("weight"), F.col("nth"), F.col("level"))
    common = F.min(F.when(~F.col("full"), turn)).over(everything)["level"]
    return opened.select(
        "src",
        "source_size",
        F.when(F.col("full"), F.col("source_size") * most)
        .otherwise(common * F.col("weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """What each document gives: ``doc_id``, ``digest``, ``source``, ``size``, ``source_size``,
    ``target`` and ``taken``, one row per row of ``docs``.

    ``taken`` counts the words a document gives, repeats included: ``taken // size`` whole copies
    and the first ``taken % size`` words of one more. Texts are read once and never shuffled.
    """
    sized = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("id"),
            F.xxhash64(F.lit("body"), F.coalesce("text", F.lit(""))).alias("digest"),
            F.col("source").cast("string").alias("src"),
            hash_key(F.col("doc_id"), seed).alias("key"),
            F.size(words(F.col("text"))).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    placed = prefix_sums(sized, ["src"], ["key", "size", "digest"], "size", "mix-ranges")
    per_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    target = targets(per_source, weights, share, most).withColumnRenamed("src", "src_")
    placed = placed.join(target, F.col("src").eqNullSafe(F.col("src_")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    rest = F.floor(F.col("target") - epochs * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    taken = F.coalesce(epochs * F.col("size") + part, F.lit(0)).cast("long")
    return placed.select(
        F.col("id").alias("doc_id"), "digest", F.col("src").alias("source"), "size", "source_size",
        "target", taken.alias("taken"),
    )


def mixed_texts(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``plan`` takes them, as ``row``, ``copy`` and ``body``.

    The last copy of the document at a source's cut holds its first words only.
    """
    whole = keyed(docs)
    plan = plan.select(F.col("doc_id").alias("id"), "digest", "size", "taken").distinct()
    copies = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    first = F.slice(words(F.col("body")), 1, (F.col("taken") % F.col("size")).cast("int"))
    return (
        whole.join(plan.where("taken > 0"), same_document(whole, plan))
        .select("row", "body", "size", "taken", copies.alias("copy"))
        .select(
            "row",
            "copy",
            F.when(F.col("copy") * F.col("size") <= F.col("taken"), F.col("body"))
            .otherwise(F.array_join(first, " "))
            .alias("body"),
        )
    )


def given(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``plan`` with ``texts``, what each gives to the mix, repeats included.

    ``taken // size`` whole copies, and at a source's cut the first words of one more; a document
    of which nothing is taken gives an empty list. Repeated rows each give what their own row of
    the plan takes, so the lists hold exactly the words taken.
    """
    # Grouping and joining by the same columns without nulls moves the texts once; a join that holds
    # for nulls would deal them out by other expressions again.
    def placed(rows: DataFrame, id_: str) -> DataFrame:
        return rows.select(
            "*", F.coalesce(id_, F.lit(0)).alias("_at"), F.col(id_).isNull().alias("_none")
        )

    document = ["_at", "_none", "digest"]
    bodies = placed(keyed(docs), "id").groupBy(*document).agg(F.first("body").alias("body"))
    rest = (F.col("taken") % F.col("size")).cast("int")
    whole = F.array_repeat("body", F.floor(F.col("taken") / F.col("size")).cast("int"))
    first = F.array_join(F.slice(words(F.col("body")), 1, rest), " ")
    texts = F.when(F.col("taken") == 0, F.array().cast("array<string>")).otherwise(
        F.when(rest == 0, whole).otherwise(F.concat(whole, F.array(first)))
    )
    return placed(plan, "doc_id").join(bodies, document).select(*plan.columns, texts.alias("texts"))
