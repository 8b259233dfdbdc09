"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from every whole text on the executors. The trees are fitted on a
bounded sample of labelled documents (at most ``SAMPLE`` rows of numbers reach the driver, never
texts), then flattened into arrays that numpy walks level by level for a batch of documents.

Defined results: null and empty texts have all-zero statistics and get a score like any other;
texts may be of any length; repeated rows get equal scores; with no usable label, or labels of
one kind only, every score is the share of label 1 (0.5 without labels). A document with several
labels counts once with each. ``doc_id``, ``lang``, ``source`` and labels are never inputs.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from wardmill.llm.common import keyed, split_words

SAMPLE = 20_000  # labelled documents the trees are fitted on, at most
THRESHOLD = 0.7
STATISTICS = (
    "words", "chars per word", "upper share", "digit share", "symbol share", "comma or stop share",
    "blank share", "wide share", "distinct words", "most frequent word", "repeated neighbours",
    "words ending in symbol", "words ending in letter", "words starting upper", "lines",
    "distinct lines", "words per line", "one-letter words", "longest word", "byte entropy",
)

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
STOP = np.zeros(256, bool)
STOP[[44, 46]] = True
SYMBOL = ~(LETTER | DIGIT | BLANK | STOP)
SYMBOL[:32] = False


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a text as a whole, in the order of ``STATISTICS``."""
    found = split_words(text)
    if not found:
        return [0.0] * len(STATISTICS)
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, n = len(data), len(found)
    shares = counts[counts > 0] / size
    lines = [line for line in data.split(b"\n") if line.strip()]
    ends = np.bincount([w[-1] for w in found], minlength=256)
    starts = np.bincount([w[0] for w in found], minlength=256)
    kinds = Counter(found)
    lengths = [len(w) for w in found]
    return [
        float(np.log1p(n)),
        sum(lengths) / n,
        counts[UPPER].sum() / size,
        counts[DIGIT].sum() / size,
        counts[SYMBOL].sum() / size,
        counts[STOP].sum() / size,
        counts[BLANK].sum() / size,
        counts[128:].sum() / size,
        len(kinds) / n,
        max(kinds.values()) / n,
        sum(map(bytes.__eq__, found, found[1:])) / n,
        ends[SYMBOL].sum() / n,
        ends[LETTER].sum() / n,
        starts[UPPER].sum() / n,
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        n / len(lines),
        lengths.count(1) / n,
        float(np.log1p(max(lengths))),
        float(-(shares * np.log2(shares)).sum()),
    ]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays of one row per tree: a node's children are 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray  # -1 where a node is a leaf
    threshold: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1 if len(self.feature) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                inner = feature[node] >= 0
                right = rows[at, np.maximum(feature[node], 0)] > threshold[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 3, bins: int = 64,
    rate: float = 0.15, least: int = 5, ridge: float = 1.0,
) -> Trees:
    """Gradient boosting of the logistic loss; splits are sought among histogram bins."""
    nodes = 2 ** (depth + 1) - 1
    none = Trees(0.0, np.zeros((0, nodes), int), np.zeros((0, nodes)), np.zeros((0, nodes)))
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Trees(float(np.log(share / (1 - share))), none.feature, none.threshold, none.value)
    base = float(np.log(share / (1 - share)))
    width = rows.shape[1] if rows.ndim == 2 else 0
    if not len(labels) or not width:
        return Trees(base, none.feature, none.threshold, none.value)
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f]) for f, c in enumerate(cuts)], axis=1)
    offset = np.arange(width) * bins
    logit = np.full(len(rows), base)
    out = [np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))]
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = p - labels, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for k in range(nodes):
            own = np.flatnonzero(node == k)
            if not len(own):
                continue
            g, h = grad[own].sum(), hess[own].sum()
            out[2][t, k] = -rate * g / (h + ridge)
            if 2 * k + 2 >= nodes:
                continue
            flat = (binned[own] + offset).ravel()
            sums = [
                np.bincount(flat, np.repeat(x, width), width * bins).reshape(width, bins).cumsum(1)
                for x in (grad[own], hess[own], np.ones(len(own)))
            ]
            gl, hl, nl = sums
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
            gain[(nl < least) | (len(own) - nl < least)] = -np.inf
            for f, c in enumerate(cuts):
                gain[f, len(c) :] = -np.inf
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            if not gain[f, b] > 1e-9:
                continue
            out[0][t, k], out[1][t, k] = f, cuts[f][b]
            node[own] = 2 * k + 1 + (binned[own, f] > b)
        logit += out[2][t, node]
    return Trees(base, *out)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` labelled rows that are not held out, chosen by hash.

    The chosen ids are few by that bound, so they are broadcast and no text is shuffled.
    """
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")
        )
        .where("id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("id")))
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(sample)
    )
    described = F.pandas_udf(lambda texts: texts.map(statistics), ArrayType(DoubleType()))
    chosen = (
        keyed(docs)
        .join(F.broadcast(known), "id")
        .select("id", "digest", "label", described("body").alias("stats"))
        .orderBy("id", "digest", "label")
        .limit(sample)
        .toPandas()
    )
    rows = np.array(chosen["stats"].tolist(), float).reshape(len(chosen), len(STATISTICS))
    return fit(rows, chosen["label"].to_numpy(float))


def scored(model: Trees, text: Column) -> Column:
    """Score of a text that is not null."""

    def run(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))
        return pd.Series(model.score(rows))

    return F.pandas_udf(run, DoubleType())(text)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` of each row of ``docs``."""
    model = train(docs, labels, sample)
    return keyed(docs).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        scored(model, F.col("body")).alias("score"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    model = train(docs, labels, sample)
    return keyed(docs).where(scored(model, F.col("body")) >= threshold).select("row.*")
