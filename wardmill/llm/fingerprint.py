"""Document fingerprints by Order MinHash, in DataFrame operations only.

A text's k-mers are its runs of ``K`` words. Each is numbered by how often it has occurred before
in the text, so that repeats count, and the numbered k-mers are hashed. The hashes are dealt into
``BINS`` bins by their leading bits, which stand for that many permutations of one hash each; of
every bin the two smallest k-mers are selected, put back into the order they have in the text, and
hashed as a tuple. A bin with fewer than two takes the next ones of the bins after it, the first bin
following the last; so every tuple of a text of two k-mers or more has an order. The likeness of two
fingerprints is the share of equal tuples. An edit changes the tuples it touches, and moving a
passage changes those whose k-mers swap their order, which a likeness of sets would not see.

Defined results: null and empty texts have no tuples, two such texts are alike by 1 and any other is
unlike them by 0; a text of fewer than ``K`` words is one k-mer; texts are taken whole (up to 2^28
words); rows with equal ids follow each other in an order set by their texts; a null doc_id comes
first; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.common import keyed, let, words

K = 3
BIN_BITS = 6
BINS = 1 << BIN_BITS
PLACE_BITS = 28  # of a k-mer's number in the text; the other 35 of 63 hold its hash


def _packed(value: Column, place: Column) -> Column:
    """A hash and a place as one positive long that sorts by hash."""
    top = F.shiftleft(F.shiftrightunsigned(value, 64 - 63 + PLACE_BITS), PLACE_BITS)
    return top.bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("long"))


def _kmers(text: Column) -> Column:
    """Hashes of the k-mers, each with its place, sorted by hash."""

    def of(hashes: Column) -> Column:
        shifted = F.arrays_zip(
            *[
                F.slice(hashes, o + 1, F.greatest(F.size(hashes) - o, F.lit(0))).alias(f"w{o}")
                for o in range(K)
            ]
        )
        count = F.when(F.size(hashes) == 0, 0).otherwise(F.greatest(F.size(hashes) - K + 1, F.lit(1)))
        return F.transform(F.slice(shifted, 1, count), lambda z, i: _packed(F.xxhash64(z), i))

    return F.sort_array(let(F.transform(words(text), lambda w: F.xxhash64(w)), of))


def _numbered(kmers: Column) -> Column:
    """The sorted k-mers, hashed with their number among equal ones, sorted anew."""

    def of(s: Column) -> Column:
        def fresh(x: Column, i: Column) -> Column:
            before = F.get(s, i - 1)
            return (i == 0) | (F.shiftright(before, PLACE_BITS) != F.shiftright(x, PLACE_BITS))

        marks = F.transform(s, lambda x, i: F.when(fresh(x, i), i))
        starts = F.filter(marks, lambda i: i.isNotNull())

        def runs(first: Column) -> Column:
            def numbered(start: Column, j: Column) -> Column:
                end = F.coalesce(F.get(first, j + 1), F.size(s))
                return F.transform(
                    F.slice(s, start + 1, end - start),
                    lambda x, o: _packed(F.xxhash64(F.shiftright(x, PLACE_BITS), o), _place(x)),
                )

            return F.sort_array(F.flatten(F.transform(first, numbered)))

        return let(starts, runs)

    return let(kmers, of)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, 63 - BIN_BITS)


def sketch(text: Column) -> Column:
    """One long for each bin, none for a text without words: the bin above 32 bits of its tuple's hash."""

    def of(s: Column) -> Column:
        # the two smallest of a bin: those whose second neighbour before is of another bin
        chosen = F.filter(s, lambda x, i: (i < 2) | (_bin(F.get(s, i - 2)) != _bin(x)))

        def tuples(c: Column) -> Column:
            def hashed(x: Column, after: Column) -> Column:
                a, b = (F.shiftright(v, PLACE_BITS) for v in (x, after))
                in_order = after.isNull() | (_place(x) < _place(after))
                return F.shiftrightunsigned(F.when(in_order, F.xxhash64(a, b)).otherwise(F.xxhash64(b, a)), 32)

            def one(x: Column, i: Column) -> Column:
                # the bins after the one before, up to its own, have x as their smallest
                before = F.when(i == 0, F.lit(-1).cast("long")).otherwise(_bin(F.get(c, i - 1)))
                after = F.when(F.size(c) > 1, F.get(c, (i + 1) % F.size(c)))
                served = F.sequence(before + 1, _bin(x))
                return F.when(
                    before != _bin(x),
                    let(hashed(x, after), lambda h: F.transform(served, lambda b: F.shiftleft(b, 32).bitwiseOR(h))),
                )

            each = F.filter(F.transform(c, one), lambda v: v.isNotNull())
            last = _bin(F.element_at(c, -1))
            around = F.when(
                last < BINS - 1,
                let(
                    F.get(c, F.lit(0)),
                    lambda x: let(
                        hashed(x, F.get(c, F.lit(1))),
                        lambda h: F.transform(
                            F.sequence(last + 1, F.lit(BINS - 1).cast("long")),
                            lambda b: F.shiftleft(b, 32).bitwiseOR(h),
                        ),
                    ),
                ),
            )
            none = F.array().cast("array<bigint>")
            return F.when(F.size(c) == 0, none).otherwise(F.concat(F.flatten(each), F.coalesce(around, none)))

        return let(chosen, tuples)

    return let(_numbered(_kmers(text)), of)


def written(fingerprint: Column) -> Column:
    """A sketch as text: ten hexadecimal digits for each tuple."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.hex(v), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples; 1 for two sketches without any, 0 if only one has none."""

    most = F.greatest(F.size(a), F.size(b))
    equal = F.size(F.array_intersect(a, b))
    return F.when(most == 0, F.lit(1.0)).otherwise(equal / most).cast("double")


def with_next(docs: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """``id``, ``body`` and ``carried`` columns of every row, with those of the next row by doc_id.

    Rows are dealt into ranges of ids of about equal size, one exchange by range, and each looks
    ahead within its range. An id that fills several ranges is dealt over as many by the digests of
    its texts. The first row of a range is also sent, as a ghost, to the end of the range before,
    the very first to the last; so no range waits for another. Only the bounds and first rows'
    ids and digests, as many as there are tasks, pass the driver.
    """
    spark = docs.sparkSession
    least = -(2**63)
    at = F.coalesce(F.col("id"), F.lit(least).cast("long")).alias("at")
    whole = keyed(docs).select("id", "digest", "body", at)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)] or [1.0]
    found = Counter(whole.agg(F.percentile_approx("at", shares, 100 * ranges)).first()[0] or [])
    bounds = sorted(found)
    rank = F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b <= F.col("at")))
    # ids that are a bound n > 1 times take n parts of their range, larger ids the part after them
    parts = F.lit([found[b] for b in bounds]).cast("array<bigint>")
    times = F.coalesce(F.get(parts, rank - 1), F.lit(1).cast("long"))
    share = F.shiftrightunsigned(F.col("digest").bitwiseXOR(F.lit(least).cast("long")), 32)
    within = (
        F.when(times == 1, 0)
        .when(F.col("at") > F.get(F.lit(bounds).cast("array<bigint>"), rank - 1), times)
        .otherwise(F.shiftrightunsigned(share * times, 32))
    )
    whole = whole.withColumn("part", rank * (ranges + 1) + within)
    least_row = F.min(F.struct("at", "digest")).alias("least")
    firsts = sorted((r.part, *r.least) for r in whole.groupBy("part").agg(least_row).collect())
    before = [(a, d, firsts[i - 1][0]) for i, (_, a, d) in enumerate(firsts)]
    ghosts = whole.drop("part").join(
        F.broadcast(spark.createDataFrame(before, "at long, digest long, part long")), ["at", "digest"]
    )
    names = ["id", "digest", "body", "at", "part"]
    both = (
        whole.select(*names, F.lit(False).alias("ghost"))
        .union(ghosts.select(*names, F.lit(True)))
        .select("id", "digest", "body", "at", "part", "ghost", *[c.alias(n) for n, c in carried.items()])
    )
    ahead = Window.partitionBy("part").orderBy("ghost", "at", "digest")
    following = [F.lead(n).over(ahead).alias(f"next_{n}") for n in ("body", *carried)]
    return both.select("id", "body", "ghost", *carried, *following).where("NOT ghost").drop("ghost")


def compare(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, both fingerprints and both likenesses.

    The edited text has its last half replaced by the first characters of the next document.
    """
    rows = with_next(docs, {"own": sketch(F.col("body"))})
    size = F.length("body")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left("body", size - half), F.left("next_body", half))
    sketched = rows.select(
        F.col("id").alias("doc_id"), size.cast("long").alias("n_chars"), "own", "next_own",
        edited.alias("edited"),
    ).select(
        "doc_id", "n_chars", "own", "next_own", F.sha2("edited", 256).alias("edited_sha256"),
        let(
            sketch(F.col("edited")),
            lambda e: F.struct(
                written(e).alias("edited_fingerprint"), likeness(F.col("own"), e).alias("near_edited")
            ),
        ).alias("edit"),
    )
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"),
        "edit.edited_fingerprint", "edit.near_edited",
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
