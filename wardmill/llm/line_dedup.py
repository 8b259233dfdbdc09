"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line goes if an earlier line (smaller doc_id, then position) equals it or is one edit away:
one character inserted, deleted or replaced. The first of equal or near lines stays.

Equal lines are grouped by a 128-bit hash. For near lines, two cheap facts come before the
neighbourhood. One edit leaves the first or the last half of a line as it is, so only lines that
share a half (and nearly a length) with another line go on; and within such a half, the edit lies
in the other one. For these, every variant with one character deleted becomes a hashed key:

* with the position of the deleted character: equal keys are lines of one length that differ in
  that character only, so the earliest of a key is a partner of all others;
* without it: equal to the key of a whole line that is one character shorter, so each key has one
  shorter line and its longer partners, who all pair with that one.

So no pairs within a group are made: each key gives every line one partner, the earliest that it
can have there, and the edit distance of that pair is verified. That loses none, because a key
follows all characters of its variant in their order: it has 64 bits of the shared half's hash and
of the XOR of hashes of (character, place) in the other half. A running XOR gives all variants of
a line of ``n`` characters in time ``n log n``.

Defined results: blank lines always stay; lines shorter than ``near_chars`` characters need to be
equal; null texts stay null and empty ones empty; a document whose lines all go is left out by
``dedup`` and has ``n_kept`` 0 in ``line_counts``; repeated rows are one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import keyed, let, same_document
from wardmill.session import stage

NEAR_CHARS = 20
PLACE = ("id", "digest", "pos")


def _lines(body: Column) -> Column:
    return F.split(body, "\n", -1)


def _halves(line: Column) -> Column:
    """Keys of the halves a line can share with one of its own length or one longer or shorter.

    First half and last half of its own length, then those of a line one shorter.
    """
    size = F.length(line)

    def keys(shorter: Column) -> list[Column]:
        half = F.floor(shorter / 2).cast("int")
        sides = (F.left(line, half), F.right(line, half))
        return [F.xxhash64(F.lit(side), shorter, part) for side, part in enumerate(sides)]

    return F.array(*keys(size), *keys(size - 1))


def _running(values: Column) -> Column:
    """XOR of each value and all before it, four times as far with every pass."""
    reach = F.filter(F.array(*[F.lit(4**k) for k in range(15)]), lambda r: r < F.size(values))

    def farther(run: Column, r: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            for k in (1, 2, 3):
                x = x.bitwiseXOR(F.coalesce(F.get(run, i - k * r), F.lit(0).cast("long")))
            return x

        return F.transform(run, one)

    return F.aggregate(reach, values, farther)


def _variants(chars: Column, side: Column, shorter: Column, half: Column) -> Column:
    """Keys of a line's variants in the half that is not shared, as structs (key, whole)."""
    size = F.size(chars)
    split = F.floor(shorter / 2).cast("int")
    # side 0 shares the first ``split`` characters, side 1 the last ones: the others are open
    open_ = F.slice(chars, F.when(side == 0, split + 1).otherwise(F.lit(1)), size - split)

    def all_of(hashes: Column) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))

    def keyed_by(place: Column, left: Column) -> Column:
        return F.xxhash64(half, shorter, place, left)

    def replaced(here: Column) -> Column:
        def keys(whole: Column) -> Column:
            deleted = F.transform(here, lambda h, i: keyed_by(i, whole.bitwiseXOR(h)))
            return F.concat(_named(deleted, False), _named(F.array(keyed_by(F.lit(-1), whole)), True))

        return let(all_of(here), keys)

    def shortened(open_: Column) -> Column:
        # Deleting one character later keeps one more in its place and moves one less.
        def step(char: Column, i: Column) -> Column:
            moved = F.when(i > 0, F.xxhash64(char, i - 1)).otherwise(F.lit(0).cast("long"))
            kept = F.when(i > 0, F.xxhash64(F.get(open_, i - 1), i - 1)).otherwise(all_moved)
            return moved.bitwiseXOR(kept)

        all_moved = all_of(
            F.transform(F.slice(open_, 2, F.size(open_)), lambda char, i: F.xxhash64(char, i))
        )
        left = let(F.transform(open_, step), _running)
        # made distinct as longs, which takes time in proportion to them
        return _named(
            F.array_distinct(F.transform(left, lambda v: keyed_by(F.lit(-1), v))), False
        )

    return F.when(
        shorter == size, let(F.transform(open_, lambda char, i: F.xxhash64(char, i)), replaced)
    ).otherwise(let(open_, shortened))


def _named(keys: Column, whole: bool) -> Column:
    return F.transform(keys, lambda key: F.struct(key.alias("key"), F.lit(whole).alias("whole")))


def _near(docs: DataFrame, distinct: DataFrame, near_chars: int) -> DataFrame:
    """First places of the distinct lines with an earlier line one edit away."""
    # A line that is one shorter has to be long enough as well.
    long_enough = F.when(F.col("chars") > near_chars, F.col("halves")).otherwise(
        F.slice("halves", 1, 2)
    )
    halves = distinct.where(F.col("chars") >= near_chars).select(
        "place", F.explode(long_enough).alias("half")
    )
    shared = halves.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1")
    kept = halves.join(shared.drop("lines"), "half").select("place.*", "half")
    # Back to the texts: each line stands where it stands first.
    whole = keyed(docs).select("id", "digest", "body")
    line = F.get(_lines(F.col("body")), F.col("pos"))
    found = whole.join(kept, same_document(whole, kept)).select(
        kept["id"], kept["digest"], "pos", "half", line.alias("line")
    )
    which = F.array_position(_halves(F.col("line")), F.col("half")) - 1
    found = stage(
        found.withColumn("which", which).select(
            F.struct(*PLACE).alias("place"), "half", "line", (F.col("which") % 2).alias("side"),
            (F.length("line") - F.floor(F.col("which") / 2)).alias("shorter"),
        ),
        "line-candidates",
    )
    keys = let(
        F.split(F.col("line"), ""),
        lambda chars: _variants(chars, F.col("side"), F.col("shorter"), F.col("half")),
    )
    variants = stage(
        found.select("place", F.explode(keys).alias("v")).select("place", "v.*"),
        "line-variants",
    )
    earliest = (
        variants.groupBy("key")
        .agg(
            F.min("place").alias("any"),
            F.min(F.when(F.col("whole"), F.col("place"))).alias("short"),
            F.min(F.when(~F.col("whole"), F.col("place"))).alias("long"),
            F.count("*").alias("lines"),
        )
        .where("lines > 1")
    )
    # A key with a whole line pairs that line with its longer ones; any other pairs equal lengths.
    partner = F.when(F.col("short").isNull(), F.col("any")).otherwise(
        F.when(F.col("whole"), F.col("long")).otherwise(F.col("short"))
    )
    pairs = (
        variants.join(earliest, "key")
        .select("place", partner.alias("partner"))
        .where("partner < place")
        .distinct()
    )
    texts = found.select("place", "line").distinct()
    return (
        pairs.join(texts, "place")
        .join(texts.toDF("partner", "other"), "partner")
        .where(F.levenshtein("line", "other", 1).between(0, 1))
        .select("place")
        .distinct()
    )


def removed_lines(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``id``, ``digest`` and the positions ``gone`` of the lines to remove, where there are any."""
    whole = keyed(docs).select("id", "digest", "body")
    line = F.col("line")
    occurrences = (
        whole.select("id", "digest", F.posexplode(_lines(F.col("body"))).alias("pos", "line"))
        .where(line.rlike(r"[^\x20\x09-\x0D]"))
        .select(
            F.xxhash64(F.lit(1), line).alias("h1"), F.xxhash64(F.lit(2), line).alias("h2"),
            "id", "digest", "pos", F.length("line").alias("chars"), _halves(line).alias("halves"),
        )
    )
    distinct = stage(
        occurrences.groupBy("h1", "h2")
        .agg(F.min(F.struct("id", "digest", "pos", "chars", "halves")).alias("one"))
        .select(
            "h1", "h2", F.struct("one.id", "one.digest", "one.pos").alias("place"),
            "one.chars", "one.halves",
        ),
        "line-distinct",
    )
    near = _near(docs, distinct, near_chars).select("place", F.lit(True).alias("near"))
    judged = (
        distinct.select("h1", "h2", "place")
        .join(near, "place", "left")
        .select("h1", "h2", F.col("place").alias("first"), "near")
    )
    return (
        occurrences.select("h1", "h2", F.struct(*PLACE).alias("place"))
        .join(judged, ["h1", "h2"])
        .where(F.col("near").isNotNull() | (F.col("first") < F.col("place")))
        .groupBy("place.id", "place.digest")
        .agg(F.collect_set("place.pos").alias("gone"))
    )


def _kept(docs: DataFrame, near_chars: int) -> DataFrame:
    whole, gone = keyed(docs), removed_lines(docs, near_chars)
    return whole.join(gone, same_document(whole, gone), "left").select(
        "row", whole["id"], "body", _lines(F.col("body")).alias("lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
    )


def _left(lines: Column, gone: Column) -> Column:
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.transform(F.array_except(every, gone), lambda i: F.get(lines, i))


def line_counts(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and ``kept``, the text that is left, of every row."""
    return _kept(docs, near_chars).select(
        F.col("id").alias("doc_id"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.array_join(_left(F.col("lines"), F.col("gone")), "\n").alias("kept"),
    )


def dedup(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` without the removed lines; a row that lost all its lines but blank ones goes.

    ``n_chars``, where there is such a column, becomes the length of the text that is left.
    """
    text = F.array_join(_left(F.col("lines"), F.col("gone")), "\n")
    kept = _kept(docs, near_chars).select(
        "row", F.when(F.size("gone") > 0, text).otherwise(F.col("row.text")).alias("kept"),
        (F.size("gone") > 0).alias("changed"),
    )
    new = kept.where(~F.col("changed") | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    length = F.coalesce(F.length("kept"), F.lit(0))
    return new.select(
        *[
            F.col("kept").alias("text")
            if name == "text"
            else F.when(F.col("changed"), length)
            .otherwise(F.col(f"row.`{name}`"))
            .cast(docs.schema[name].dataType)
            .alias(name)
            if name == "n_chars"
            else F.col(f"row.`{name}`").alias(name)
            for name in docs.columns
        ]
    )
