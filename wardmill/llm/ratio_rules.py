"""Quality rules: a log-likelihood ratio of hashed n-grams beside plain counts of each text.

Words and pairs of neighbouring words fall into ``BUCKETS`` buckets. Two multinomials over the
buckets are counted: one of trusted documents, which are labelled as good, and one of all documents.
The weight of a bucket is the logarithm of its share in the one over its share in the other, each
count one higher so that none is nothing. The score of a text is the mean weight of its n-grams, so
long and short texts compare; a text is kept if its score is ``THRESHOLD`` or more and the plain rules
have not failed it. Weights are whole numbers of 2 ** -16, so sums and verdicts do not depend on any order.

Each task adds up its own buckets first, so the corpus counts shuffle at most ``BUCKETS`` rows a task;
the table of weights, one number a bucket, is the only thing the driver holds. Trusted documents are
at most ``SAMPLE`` ids, chosen by hash and broadcast, so no text is shuffled; the counts of the
corpus cover every text.

Defined results: null and empty texts have no words, count nothing and fail; a text without
n-grams has the score 0; repeated rows count again in the corpus and get equal verdicts; a null
doc_id is never trusted; labels that are null or neither 0 nor 1 say nothing, a document labelled
both ways is not trusted; without trusted documents all weights are 0 and the plain rules decide;
texts of any length are taken whole by one task; extra columns are ignored; no documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import WordHashes, keyed, paired, word_chunks

BUCKETS = 65_521
SAMPLE = 20_000  # trusted documents, at most
THRESHOLD = -0.25  # nats an n-gram
UNIT = 1 << 16
MIX = 1_000_003
REPEATED = 8  # words of a window whose repeats are counted
FEW_WORDS, MOST_REPEATED = 20, 30  # words, percent of words
SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\v\f\r"


class Md5Hashes(WordHashes):
    """The first 64 bits of a word's MD5; SQL engines can compute them too."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.md5(word).digest()[:8], "big")
        return value


def _grams(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of the pairs within a text, with the text of each."""
    ids = (flat >> np.uint64(32)).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    pairs = (ids[:-1] * MIX + ids[1:]) % BUCKETS
    inside = owner[:-1] == owner[1:]
    return np.concatenate([ids % BUCKETS, pairs[inside]]), np.concatenate([owner, owner[:-1][inside]])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Md5Hashes()
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column("trusted").to_numpy(zero_copy_only=False), bool)
        for first, flat, lengths in word_chunks(batch.column("body").to_pylist(), known):
            bucket, owner = _grams(flat, lengths)
            good = trusted[first + owner]
            counts[0] += np.bincount(bucket[good], minlength=BUCKETS)
            counts[1] += np.bincount(bucket, minlength=BUCKETS)
    hit = np.flatnonzero(counts[1])
    yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[0][hit]), pa.array(counts[1][hit])], ["bucket", "good", "all"])


def trusted_ids(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` documents that all labels call good, the same ones each time."""
    good = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("q"))
        .where("id IS NOT NULL AND q IN (0, 1)")
        .groupBy("id")
        .agg(F.min("q").alias("q"))
        .where("q = 1")
    )
    return good.orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample).select("id")


def weights(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weight of each bucket, in units of 2 ** -16 nats."""
    good = trusted_ids(labels, sample).withColumn("trusted", F.lit(True))  # bounded by the sample
    marked = keyed(docs).join(F.broadcast(good), "id", "left")
    rows = (
        marked.select(F.coalesce("trusted", F.lit(False)).alias("trusted"), "body")
        .mapInArrow(_counted, "bucket long, good long, all long")
        .groupBy("bucket")
        .agg(F.sum("good").alias("good"), F.sum("all").alias("all"))
        .collect()  # one row a bucket
    )
    counts = np.ones((2, BUCKETS), np.int64)
    for bucket, good_, all_ in rows:
        counts[:, bucket] += (good_, all_)
    total = counts.sum(axis=1)
    if total[0] == BUCKETS:
        return np.zeros(BUCKETS, np.int64)
    ratio = (counts[0] / total[0]) / (counts[1] / total[1])
    return np.floor(UNIT * np.log(ratio) + 0.5).astype(np.int64)


def _repeated_words(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    texts, n = len(lengths), len(flat)
    if n < REPEATED:
        return np.zeros(texts, np.int64)
    h, width = flat, 1
    while width < REPEATED:
        h = paired(h[:-width], h[width:], width)
        width *= 2
    owner = np.repeat(np.arange(texts), lengths)
    at = np.flatnonzero(owner[: len(h)] == owner[REPEATED - 1 :])
    order = at[np.lexsort((h[at], owner[at]))]
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edges = np.zeros(n + 1, np.int64)
    edges[order[twice]] += 1
    edges[order[twice] + REPEATED] -= 1
    return np.bincount(owner[np.cumsum(edges)[:n] > 0], minlength=texts)


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _judged(weight: np.ndarray, threshold: float):
    least = int(np.floor(threshold * UNIT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Md5Hashes()
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            for first, flat, lengths in word_chunks(bodies, known):
                n = len(lengths)
                texts = bodies[first : first + n]
                bucket, owner = _grams(flat, lengths)
                grams = np.bincount(owner, minlength=n)
                order = np.argsort(owner, kind="stable")
                sums = np.concatenate([[0], np.cumsum(weight[bucket[order]])])
                ends = np.cumsum(grams)
                ratio = sums[ends] - sums[ends - grams]
                chars = [len(t) - sum(map(t.count, BLANKS)) for t in texts]
                symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
                repeated = _repeated_words(flat, lengths)
                failed = (lengths < FEW_WORDS) | (100 * repeated > MOST_REPEATED * lengths)
                columns = {
                    "doc_id": batch.column("id").slice(first, n), "digest": batch.column("digest").slice(first, n),
                    "n_words": lengths, "word_chars": chars, "n_symbols": symbols,
                    "n_dup_lines": [_repeated_lines(t) for t in texts], "n_repeat_words": repeated,
                    "n_grams": grams, "score": ratio / np.maximum(grams, 1) / UNIT,
                    "base_failed": failed, "kept": ~failed & (ratio >= least * grams),
                }
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
                )

    return run


JUDGED = (
    "doc_id long, digest long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_grams long, score double, base_failed boolean, kept boolean"
)


def judge(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE
) -> DataFrame:
    """Counts, score and verdict of every row of ``docs``."""
    weight = weights(docs, labels, sample)
    return keyed(docs).select("id", "digest", "body").mapInArrow(_judged(weight, threshold), JUDGED)


def accepted(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE
) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    judged = judge(docs, labels, threshold, sample)
    whole = keyed(docs)
    gone = judged.where("NOT kept").select("doc_id", "digest").distinct()
    same = whole["id"].eqNullSafe(gone["doc_id"]) & (whole["digest"] == gone["digest"])
    return whole.join(gone, same, "left_anti").select("row.*")
