"""Near-duplicate documents: SuperMinHash, banding, verification, union-find grouping.

A document is the set of its distinct shingles (runs of ``shingle`` words, ASCII letters lowered;
a shorter text is one shingle). Documents with equal sets form a class with one representative,
so copies are never compared. SuperMinHash gives every representative ``SLOTS`` minima: in round
``j`` each shingle draws a rank between ``j`` and ``j + 1`` for the ``j``-th slot of a random
permutation of its own, and the rounds stop early once all slots are filled, because later ranks
are larger. ``BANDS`` bands of slots are the keys under which candidates meet.

Groups of candidates are not expanded into pairs. First every member is compared with the
smallest of its group, on full sets, and the links found are grouped into components. What is left
are groups whose members lie in several components. Their sets are put in one order, rare shingles
first, and each is filed under its first ones: two sets as alike as asked must share one of the first
``n - ceil(0.8 n) + 1``, and what a whole group has in common comes last and files nobody. Again
every member is first compared with a few leaders under each shingle, again while that finds
links, and at last all that still share a shingle across components. This loses no link; what
remains unseen is what bands miss: of pairs just at similarity 0.8, one in 20 million shares none.

Defined results: texts without words have an empty set and no link; a row without doc_id has no
link and stands for itself; a doc_id names one document, so repeated rows are that document and
different texts under one doc_id are linked by it, in whatever order the rows come; texts of any
length are taken whole, by one task; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import WordHashes, keyed, mixed, paired, word_chunks
from wardmill.llm.components import components
from wardmill.session import stage

SLOTS, BANDS = 128, 32
HEAD = 32  # keys that a set carries along, to know the first one it shares
LEADERS = 4  # under each shingle
CELLS, SHARD = 1 << 20, 1 << 14  # counts of shingles that put them in order, and those of one row
EMPTY = np.int64(2**62)


def shingle_sets(flat: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts, sorted within each: (text number, hash)."""
    texts = len(lengths)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(texts), lengths)
    grams = flat
    for i in range(1, size):
        grams = paired(grams[: len(flat) - i], flat[i:], i) if len(flat) > i else flat[:0]
    at = np.arange(len(grams))
    whole = at + size <= ends[owner[: len(grams)]]
    hashes, owners = grams[whole], owner[: len(grams)][whole]
    few = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(few):
        extra = []
        for t in few:
            own = flat[ends[t] - lengths[t] : ends[t]]
            h = own[:1]
            for i in range(1, len(own)):
                h = paired(h, own[i : i + 1], i)
            extra.append(mixed(h + np.uint64(len(own)))[0])
        hashes = np.concatenate([hashes, np.array(extra, np.uint64)])
        owners = np.concatenate([owners, few])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], hashes[new]


def super_minhash(owners: np.ndarray, hashes: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures, one row per text; rank ``j + r`` is kept as ``j << 32 | r``."""
    signature = np.full((texts, slots), EMPTY, np.int64)
    if not len(hashes):
        return signature
    flat, own, seed = signature.reshape(-1), owners.copy(), hashes.copy()
    order: np.ndarray | None = None  # each shingle's permutation, as far as it is drawn
    for j in range(slots):
        draw = mixed(seed + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        rank = (draw & np.uint64(0xFFFFFFFF)).astype(np.int64) | (j << 32)
        k = j + ((draw >> np.uint64(32)) % np.uint64(slots - j)).astype(np.int64)
        if order is None:
            slot = k
        else:
            at = np.arange(len(own))
            slot = order[at, k].astype(np.int64)
            order[at, k] = order[:, j]
        np.minimum.at(flat, own * slots + slot, rank)
        todo = (signature.max(axis=1) == EMPTY)[own]
        # all slots filled: no later rank is smaller, since it starts from j + 1
        if not todo.any():
            break
        if order is None:
            own, seed, k = own[todo], seed[todo], k[todo]
            order = np.tile(np.arange(slots, dtype=np.int16), (len(own), 1))
            order[np.arange(len(own)), k] = 0
        elif not todo.all():
            own, seed, order = own[todo], seed[todo], order[todo]
    return signature


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    texts, slots = signature.shape
    parts = signature.astype(np.uint64).reshape(texts, bands, slots // bands)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (texts, bands)).copy()
    for i in range(slots // bands):
        key = paired(key, parts[:, :, i], i)
    return key.astype(np.int64)


def _lists(values: np.ndarray, owners: np.ndarray, texts: int) -> pa.Array:
    offsets = np.searchsorted(owners, np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _signed(size: int, slots: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for first, flat, lengths in word_chunks(texts, known, lower=True):
                n = len(lengths)
                owners, hashes = shingle_sets(flat, lengths, size)
                count = np.bincount(owners, minlength=n)
                sums = []  # two sums over the set identify it
                for salt in (1, 2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + np.uint64(salt)))])
                    ends = np.cumsum(count)
                    sums.append((total[ends] - total[ends - count]).astype(np.int64))
                keys = _bands(super_minhash(owners, hashes, n, slots), bands)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, n) for c in ("id", "digest")),
                        pa.array(count, pa.int64()), *map(pa.array, sums), lists,
                    ],
                    ["id", "digest", "n", "k1", "k2", "bands"],
                )

    return run


def _set_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for first, flat, lengths in word_chunks(texts, known, lower=True):
                n = len(lengths)
                owners, hashes = shingle_sets(flat, lengths, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(first, n), _lists(hashes, owners, n)],
                    ["rep", "grams"],
                )

    return run


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes + np.uint64(3)) & np.uint64(CELLS - 1)).astype(np.int64)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        flat = np.asarray(batch.column("grams").flatten()).view(np.uint64)
        counts += np.bincount(_cells(flat), minlength=CELLS)
    yield from _sharded(enumerate(counts.reshape(-1, SHARD)))


def _sharded(shards) -> Iterator[pa.RecordBatch]:
    for i, counts in shards:
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["shard", "counts"]
            )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(batch.column("shard").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            total[i] = total.get(i, 0) + np.frombuffer(data, np.int64)
    yield from _sharded(total.items())


def _rarity(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each cell occur in all sets; a table of fixed size."""
    shape = "shard int, counts binary"
    parts = sets.select("grams").mapInArrow(_cell_counts, shape).repartition("shard").mapInArrow(_added, shape)
    counts = np.zeros((CELLS // SHARD, SHARD), np.int64)
    for shard, data in parts.collect():
        counts[shard] = np.frombuffer(data, np.int64)
    return counts.ravel()


def _filed(rarity, percent: int):
    """The shingles that each set is filed under, with their places in the common order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                hashes = np.asarray(batch.column("grams")[i].values).view(np.uint64)
                order = np.lexsort((hashes, rarity.value[_cells(hashes)]))
                keys = len(hashes) - -(-percent * len(hashes) // 100) + 1
                kept = hashes[order[:keys]].view(np.int64)
                head = pa.scalar(kept[:HEAD].tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kept), pa.repeat(batch.column("rep")[i], len(kept)),
                        pa.repeat(pa.scalar(len(hashes), pa.int64()), len(kept)),
                        pa.array(np.arange(len(kept), dtype=np.int32)), pa.repeat(head, len(kept)),
                    ],
                    ["key", "rep", "n", "pos", "head"],
                )

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return (
        pairs.join(sets.toDF("a", "x"), "a")
        .join(sets.toDF("b", "y"), "b")
        .where(100 * common.cast("long") >= percent * union.cast("long"))
        .select("a", "b")
    )


def _alike_in_size(percent: int, n: Column, m: Column) -> Column:
    """Sets can only reach the similarity if the smaller has that share of the larger."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _can_be_alike(percent: int, p: str, q: str) -> Column:
    """Whether sets filed under one shingle at these places can have enough in common.

    At the first shingle they share, what they can share yet is what follows it in both.
    """
    n, m = F.col(f"{p}.n"), F.col(f"{q}.n")
    common = F.least(n - F.col(f"{p}.pos"), m - F.col(f"{q}.pos"))
    return _alike_in_size(percent, n, m) & ((100 + percent) * common >= percent * (n + m))


def _one_by_one(filed: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components, for sets that are ``filed``; returns all links.

    A pair is made at the first key that both share; this is known if both carry it along among
    their first ones, else the pair is made at each shared key.
    """
    tried = None
    while True:
        found = components(links)
        placed = filed.join(found, filed["rep"] == found["node"], "left").select(
            "key", "rep", "n", "pos", "head", F.coalesce("component", "rep").alias("component")
        )
        one = F.struct("rep", "n", "pos", "component")
        keys = placed.groupBy("key").agg(
            F.array(*[F.min_by(one, F.xxhash64("rep", F.lit(i))) for i in range(LEADERS)]).alias("leaders"),
            F.min("component").alias("lo"), F.max("component").alias("hi"),
        )
        keys = stage(keys.where("lo < hi").select("key", F.array_distinct("leaders").alias("leaders")), "near-keys")
        placed = stage(placed.join(keys.select("key"), "key"), "near-placed")
        pairs = (
            placed.drop("head").alias("p")
            .join(keys.select("key", F.explode("leaders").alias("q")), "key")
            .where(F.col("p.component") != F.col("q.component"))
            .where(_can_be_alike(percent, "p", "q"))
            .select(F.least("p.rep", "q.rep").alias("a"), F.greatest("p.rep", "q.rep").alias("b"))
            .distinct()
        )
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-pairs")
        more = stage(_verified(pairs, sets, percent), "near-links")
        tried = pairs if tried is None else tried.union(pairs)
        if more.isEmpty():
            break
        links = links.union(more)
    rest = (
        placed.alias("p")
        .join(
            placed.alias("q"),
            (F.col("p.key") == F.col("q.key"))
            & (F.col("p.rep") < F.col("q.rep"))
            & (F.col("p.component") != F.col("q.component"))
            & _can_be_alike(percent, "p", "q")
            & F.coalesce(F.get(F.array_intersect("p.head", "q.head"), 0) == F.col("p.key"), F.lit(True)),
        )
        .select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    return links.union(stage(_verified(rest, sets, percent), "near-links"))


def group(docs: DataFrame, shingle: int = 5, percent: int = 80, slots: int = SLOTS, bands: int = BANDS) -> DataFrame:
    """``doc_id``, ``digest``, ``n_shingles``, ``component_id``, ``kept`` of each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach.
    """
    whole = keyed(docs)
    signed = stage(
        whole.select("id", "digest", "body").mapInArrow(
            _signed(shingle, slots, bands),
            "id long, digest long, n long, k1 long, k2 long, bands array<long>",
        ),
        "near-signatures",
    )
    # Classes are numbered where they are written, so two texts under one doc_id stay apart.
    classes = stage(
        signed.where("n > 0 AND id IS NOT NULL")
        .groupBy("n", "k1", "k2")
        .agg(F.min(F.struct("id", "digest", "bands")).alias("one"))
        .select(
            F.monotonically_increasing_id().alias("rep"), "n", "k1", "k2", "one.id", "one.digest", "one.bands"
        ),
        "near-classes",
    )
    named = classes.select("n", "k1", "k2", "rep")
    rows = stage(
        signed.select("id", "digest", "n", "k1", "k2")
        .join(named, ["n", "k1", "k2"], "left")
        .select("id", "digest", "n", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep")),
        "near-rows",
    )
    several = rows.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    same_id = rows.join(stage(several, "near-ids"), "id").where("rep > a").select("a", F.col("rep").alias("b"))
    banded = stage(classes.select("rep", "n", F.explode("bands").alias("key")), "near-bands")
    shared = banded.groupBy("key").agg(
        F.min(F.struct("rep", "n")).alias("least"), F.count("*").alias("members")
    )
    shared = stage(shared.where("members > 1"), "near-shared")
    met = banded.join(shared, "key")
    led = (
        met.where("rep > least.rep")
        .where(_alike_in_size(percent, F.col("n"), F.col("least.n")))
        .select(F.col("least.rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    led = stage(led, "near-led")
    members = met.select("rep").distinct()
    reps = classes.join(members, "rep").select("rep", "id", "digest")
    texts = whole.select("id", "digest", "body")
    sets = stage(
        texts.join(reps, ["id", "digest"])
        .select("rep", "body")
        .mapInArrow(_set_of(shingle), "rep long, grams array<long>")
        .groupBy("rep")
        .agg(F.first("grams").alias("grams")),
        "near-sets",
    )
    links = stage(_verified(led, sets, percent).union(same_id.distinct()), "near-links")
    found = components(links)
    # What is left: members of one group that the first links have not joined.
    placed = banded.join(found, banded["rep"] == found["node"], "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    split = stage(split.where("lo < hi").select("key"), "near-split")
    open_ = stage(sets.join(placed.join(split, "key").select("rep").distinct(), "rep"), "near-open")
    rarity = docs.sparkSession.sparkContext.broadcast(_rarity(open_))
    filed = stage(
        open_.mapInArrow(_filed(rarity, percent), "key long, rep long, n long, pos int, head array<long>"), "near-filed"
    )
    final = components(_one_by_one(filed, links, sets, percent))
    grouped = classes.join(final, classes["rep"] == final["node"], "left").select(
        classes["rep"], "id", F.coalesce("component", "rep").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("id").alias("least"))
    named = stage(grouped.join(stage(least, "near-least"), "component").select("rep", "least"), "near-named")
    return (
        rows.join(named, "rep", "left")
        .select(
            F.col("id").alias("doc_id"), "digest", F.col("n").alias("n_shingles"),
            F.coalesce("least", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def dedup(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group, unchanged; repeated rows stay or go alike."""
    whole = keyed(docs)
    gone = group(docs, shingle, percent).where("NOT kept").select("doc_id", "digest").distinct()
    same = (whole["id"] == gone["doc_id"]) & (whole["digest"] == gone["digest"])
    return whole.join(gone, same, "left_anti").select("row.*")
