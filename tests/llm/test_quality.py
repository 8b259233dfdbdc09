from __future__ import annotations

import zlib

import numpy as np
import pytest
from odd import ODD
from oracle import DATA

from wardmill.llm import quality as q


def walk(model: q.Trees, row) -> float:
    """One row through all trees, node by node."""
    total = model.base
    for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
        node = 0
        while feature[node] >= 0:
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_score_like_single_walks():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(500, 6)).round(1)
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    model = q.fit(rows, labels, trees=40)
    scores = model.score(rows)
    assert np.allclose(scores, [walk(model, r) for r in rows])
    assert ((scores > 0.5) == labels).mean() > 0.95


def test_first_split_is_the_best_one():
    rows = np.array([[0.0], [1.0], [2.0], [3.0], [4.0], [5.0]] * 4)
    labels = (rows[:, 0] > 2).astype(float)
    model = q.fit(rows, labels, trees=1, depth=1, least=1)
    assert model.feature[0, 0] == 0 and 2 <= model.threshold[0, 0] < 3


def test_held_out_accuracy(spark):
    sf = DATA / "sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    right = np.mean([(r.score >= q.THRESHOLD) == (r.quality == 1) for r in rows])
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    assert right > 0.93 and np.mean([g > b for g in good for b in bad]) > 0.95


def test_held_out_labels_do_not_matter(spark):
    sf = DATA / "sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality"
    )
    assert sorted(q.score(docs, labels).collect()) == sorted(q.score(docs, flipped).collect())


@pytest.mark.parametrize("given", [[], [(0, 1)], [(0, 1), (4, 0)], [(None, 1), (0, None), (0, 7)]])
def test_odd_texts_and_labels(documents, spark, given):
    docs = documents([*ODD, "plain words here"])
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    rows = q.score(docs, labels).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert q.accepted(docs, labels, 0.0).columns == docs.columns
    assert q.accepted(docs, labels, 0.0).count() == len(rows)
    assert q.score(docs.limit(0), labels).count() == 0


def test_sample_is_bounded(documents, spark):
    docs = documents([(i % 50, f"text {i} " * (i % 9)) for i in range(300)])
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(100)], "doc_id long, quality int")
    model = q.train(docs, labels, sample=7)
    assert np.isfinite(model.value).all()
