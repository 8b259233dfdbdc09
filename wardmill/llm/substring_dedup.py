"""Substring dedup: repeated runs of words, with a count-min sketch as prefilter.

A window is ``WINDOW`` consecutive words of a document. A word goes if it lies in a window whose
words also start earlier (in a smaller doc_id, or earlier in the same document).

Each window has an anchor: the smallest hash among its runs of ``ANCHOR`` words, the leftmost one
if there are several. Windows with equal words have equal anchors, at the same place within them,
so the number of places where an anchor is chosen is never less than the number of times that any
window with this anchor occurs. The sketch counts anchors, a sixth as many as windows, up to two:

1. every task makes sparse sketches of its part: the cells of ``ROWS`` hash rows it has hit once,
   or more often;
2. they are merged cell by cell, shard after shard, into one bit a cell: hit at least twice. An
   estimate is never below the truth, so no repeated window is lost;
3. the second pass sends on only windows whose anchor is hit twice in all rows; these are grouped
   exactly, by 128 bits, and of each group the first place goes back to its document;
4. the last pass finds the same windows again and removes those that are not first.

So one table is shuffled by window, with the smallest place pre-aggregated: a window that a third
of all documents hold needs one row of each task. The merged bits are broadcast. Their number
follows the size of the text up to ``MOST_CELLS`` in a row (64 MB); beyond that, more windows pass
the filter, and the result stays the same.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; a
null doc_id comes first; repeated rows are one document, so they lose the same words; a text of
any length is taken whole, by one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import WordHashes, keyed, mixed, paired, same_document, split_words, word_chunks
from wardmill.session import stage

WINDOW, ANCHOR = 20, 10
ROWS = 2
SHARD = 1 << 20  # cells of a shard
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 29
FLUSH = 1 << 22  # anchors a task holds before it writes a sketch


def _run_hashes(flat: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hashes of all runs of ``size`` elements, by doubling."""
    if len(flat) < size:
        return flat[:0]
    power, spans = 1, {1: mixed(flat + np.uint64(salt))}
    while 2 * power <= size:
        h = spans[power]
        spans[2 * power] = paired(h[:-power], h[power:], salt)
        power *= 2
    whole, at = spans[power], power
    for p in sorted(spans, reverse=True)[1:]:
        if size & p:
            whole = paired(whole[: len(flat) - at - p + 1], spans[p][at : len(flat) - p + 1], salt)
            at += p
    return whole


def _rolling(values: np.ndarray, size: int, smallest) -> np.ndarray:
    """Minimum or maximum of every ``size`` neighbours."""
    width = 1
    while 2 * width <= size:
        values = smallest(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return smallest(values[:-rest], values[rest:]) if rest else values


def _anchors(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of each window, whether the window is inside one text, and the text of each word."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    if len(flat) < WINDOW:
        return flat[:0], np.zeros(0, bool), owner
    low = _rolling(_run_hashes(flat, ANCHOR, 1), WINDOW - ANCHOR + 1, np.minimum)
    inside = owner[: len(low)] == owner[WINDOW - 1 :]
    return low, inside, owner


def _chosen(flat: np.ndarray, low: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Anchors of a chunk, once for each place where they are chosen."""
    runs = _run_hashes(flat, ANCHOR, 1)
    reach = WINDOW - ANCHOR
    pad = np.zeros(reach, np.uint64)
    highest = _rolling(np.concatenate([pad, np.where(inside, low, 0).astype(np.uint64), pad]), reach + 1, np.maximum)
    return runs[(highest == runs) & (runs > 0)]


def _cells(anchors: np.ndarray, row: int, width: int) -> np.ndarray:
    return mixed(anchors + np.uint64(0x51ED270B * (row + 1))) & np.uint64(width - 1)


def _sketched(width: int):
    """Sparse sketches of a task's texts: cells hit once, and cells hit more often, by shard."""

    def sketch(anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, shards, once, more = [], [], [], []
        for row in range(ROWS):
            cells, counts = np.unique(_cells(anchors, row, width), return_counts=True)
            shard = (cells // np.uint64(SHARD)).astype(np.int64)
            inner = (cells % np.uint64(SHARD)).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                rows.append(row)
                shards.append(int(shard[a]))
                for to, keep in ((once, counts[a:b] == 1), (more, counts[a:b] > 1)):
                    gaps = np.diff(inner[a:b][keep], prepend=np.uint32(0)).astype(np.uint32)
                    # byte by byte, so that the zeros of small gaps stand together and compress
                    to.append(gaps.view(np.uint8).reshape(-1, 4).T.tobytes())
                if len(rows) >= 256:
                    yield batch_of(rows, shards, once, more)
                    rows, shards, once, more = [], [], [], []
        if rows:
            yield batch_of(rows, shards, once, more)

    def batch_of(rows, shards, once, more) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int32()), pa.array(shards, pa.int32()),
                pa.array(once, pa.binary()), pa.array(more, pa.binary()),
            ],
            ["row", "shard", "once", "more"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = WordHashes(), [], 0
        for batch in batches:
            for _, flat, lengths in word_chunks(batch.column("body").to_pylist(), known):
                low, inside, _ = _anchors(flat, lengths)
                if not len(low):
                    continue
                held.append(_chosen(flat, low, inside))
                size += len(held[-1])
                if size >= FLUSH:
                    yield from sketch(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield from sketch(np.concatenate(held))

    return run


def _cells_of(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint32)
    gaps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the cells hit at least twice, for the shards of this task."""
    hit: dict = defaultdict(lambda: np.zeros(SHARD, np.uint8))
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("row", "shard", "once", "more"))
        for row, shard, once, more in zip(*columns, strict=True):
            counts = hit[row, shard]
            cells = _cells_of(once)
            counts[cells] = np.minimum(counts[cells] + 1, 2)
            counts[_cells_of(more)] = 2
    for (row, shard), counts in hit.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row], pa.int32()), pa.array([shard], pa.int32()),
                pa.array([np.packbits(counts >= 2, bitorder="little").tobytes()], pa.binary()),
            ],
            ["row", "shard", "bits"],
        )


class Sketch:
    """Bits of the merged sketch, broadcast once and read by all tasks of a worker."""

    def __init__(self, spark, docs: DataFrame):
        size = (docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // 8
        width = LEAST_CELLS
        while width < min(size, MOST_CELLS):
            width *= 2
        self.width = width
        shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sparse = docs.select("body").mapInArrow(
            _sketched(width), "row int, shard int, once binary, more binary"
        )
        merged = sparse.repartition(shuffled, "row", "shard").mapInArrow(
            _merged, "row int, shard int, bits binary"
        )
        bits = [bytearray(width // 8) for _ in range(ROWS)]
        part = SHARD // 8
        for row, shard, data in merged.collect():  # at most ROWS * MOST_CELLS bits
            bits[row][shard * part : (shard + 1) * part] = data
        self.bits = spark.sparkContext.broadcast([bytes(b) for b in bits])

    def repeated(self, low: np.ndarray) -> np.ndarray:
        """Whether the sketch has these anchors at least twice."""
        kept = np.arange(len(low))
        for row, data in enumerate(self.bits.value):
            cells = _cells(low[kept], row, self.width)
            bytes_ = np.frombuffer(data, np.uint8)[(cells >> np.uint64(3)).astype(np.int64)]
            kept = kept[(bytes_ >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(low), bool)
        out[kept] = True
        return out

    def __getstate__(self):
        return {"width": self.width, "bits": self.bits}


def _windows(sketch: Sketch):
    """Windows that may be repeated: two hashes, and their first place in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, digests = batch.column("id"), batch.column("digest")
            for first, flat, lengths in word_chunks(batch.column("body").to_pylist(), known):
                low, inside, owner = _anchors(flat, lengths)
                at = np.flatnonzero(inside)
                at = at[sketch.repeated(low[at])]
                if not len(at):
                    continue
                h1 = _run_hashes(flat, WINDOW, 3)[at].view(np.int64)
                h2 = _run_hashes(flat, WINDOW, 4)[at].view(np.int64)
                text = owner[at]
                order = np.lexsort((at, h2, h1, text))
                new = np.ones(len(order), bool)
                for x in (text, h1, h2):
                    y = x[order]
                    new[1:] &= y[1:] == y[:-1]
                new[1:] = ~new[1:]
                kept = np.sort(order[new])
                rows = pa.array(first + text[kept])
                starts = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1[kept]), pa.array(h2[kept]), ids.take(rows), digests.take(rows),
                        pa.array((at - starts[text])[kept], pa.int32()),
                    ],
                    ["h1", "h2", "id", "digest", "pos"],
                )

    return run


def _removed(sketch: Sketch):
    """Words of each document, how many go, and the text of the others, joined by one blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column("body").to_pylist()
            firsts = batch.column("firsts").to_pylist()
            for first, flat, lengths in word_chunks(texts, known):
                gone, kept_texts = [], []
                low, inside, _ = _anchors(flat, lengths)
                ends = np.cumsum(lengths)
                repeated = np.zeros(len(flat) + 1, np.int64)
                at = np.flatnonzero(inside)
                repeated[at[sketch.repeated(low[at])]] = 1
                for i, own in enumerate(firsts[first : first + len(lengths)]):
                    if own:
                        repeated[ends[i] - lengths[i] + np.array(own)] = 0
                # a word is covered if a repeated window starts at most 19 words before it
                sums = np.cumsum(repeated[:-1])
                covered = sums.copy()
                covered[WINDOW:] -= sums[:-WINDOW]
                for i, n in enumerate(lengths):
                    words = covered[ends[i] - n : ends[i]] > 0
                    found = split_words(texts[first + i])
                    gone.append(int(words.sum()))
                    kept_texts.append(
                        b" ".join([w for w, c in zip(found, words.tolist(), strict=True) if not c])
                    )
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, n) for c in ("id", "digest")),
                        pa.array(lengths, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array(kept_texts, pa.string()),
                    ],
                    ["doc_id", "digest", "n_words", "n_removed", "kept"],
                )

    return run


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest``, ``n_words``, ``n_removed``, ``kept``, ``kept_sha256`` of every row.

    ``kept`` is the text that is left, its words joined by one blank.
    """
    spark = docs.sparkSession
    whole = keyed(docs).select("id", "digest", "body")
    sketch = Sketch(spark, whole)
    place = F.min(F.struct("id", "digest", "pos")).alias("place")
    firsts = stage(
        whole.mapInArrow(_windows(sketch), "h1 long, h2 long, id long, digest long, pos int")
        .groupBy("h1", "h2")
        .agg(place)
        .groupBy("place.id", "place.digest")
        .agg(F.sort_array(F.collect_list("place.pos")).alias("firsts")),
        "substring-firsts",
    )
    joined = whole.join(firsts, same_document(whole, firsts), "left").select(
        whole["id"], whole["digest"], "body", "firsts"
    )
    return joined.mapInArrow(
        _removed(sketch),
        "doc_id long, digest long, n_words long, n_removed long, kept string",
    ).withColumn("kept_sha256", F.sha2("kept", 256))
