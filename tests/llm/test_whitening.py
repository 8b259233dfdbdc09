from __future__ import annotations

import math

import numpy as np
import pytest
from oracle import DATA

from wardmill.llm import whitening
from wardmill.llm.whitening import Spectrum

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in rows], SCHEMA).repartition(5)


def exact(rows):
    """The contract by plain numpy and Python's integers."""
    kept = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v]))
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    off = np.array(fit, float) - mean
    v = off.T @ off / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return kept, n, sums, mean, e, q, np.trace(v)


def check(spark, rows, d):
    kept, n, sums, mean, e, q, trace = exact(rows)
    got = whitening.whiten(frame(spark, rows)).collect()
    k = min(4, d)
    assert len(got) == len(kept) * k
    key = lambda i: (i is None, i)
    got.sort(key=lambda r: (key(r.vec_id), r.deviation, r.component))
    want = sorted(
        ((key(i), sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), x) for i, x in kept)
    )
    white = np.array([r.whitened for r in got], float).reshape(-1, k)
    for r, (i, deviation, _) in zip(got[::k], want, strict=True):
        assert (key(r.vec_id), r.deviation, r.n) == (i, deviation, n)
    for c in range(k):
        assert {r.component for r in got[c::k]} == {c + 1}
        assert all(abs(r.explained - e[c] / trace) <= 1e-10 for r in got[c::k])
        expected = (np.array([x for *_, x in want], float) - mean) @ q[:, c] / np.sqrt(e[c])
        sign = np.sign(expected @ white[:, c])
        assert np.abs(white[:, c] - sign * expected).max() < 1e-8
    assert max(r.identity_error for r in got) < 1e-9


def vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(1, 0.2, d) + 0.3).astype(np.float32)


@pytest.mark.parametrize("n,d", [(300, 16), (40, 3), (9, 20)])
def test_whitening_against_plain_eigenvectors(spark, n, d):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(n, d))]
    check(spark, rows + [(1000 + i, v) for i, v in rows[:5]] + [(None, rows[0][1])], d)
    repeated = whitening.whiten(frame(spark, rows + rows[:5])).collect()
    assert len(repeated) == (n + 5) * min(4, d) and {r.n for r in repeated} == {n}


def test_rows_that_go_and_rows_that_stay(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(30, 5))]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0] * 4, [None] + [1.0] * 4, [nan] + [1.0] * 4, [1.0] * 4 + [inf], [-inf] * 5]
    check_rows = rows + [(100 + i, v) for i, v in enumerate(odd) if v is None or len(v) == 5]
    check(spark, check_rows, 5)
    got = whitening.whiten(frame(spark, rows + [(100 + i, v) for i, v in enumerate(odd)]))
    assert {r.vec_id for r in got.collect()} == set(range(30))


def test_no_variance_no_rows_and_too_large(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    same = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in same} == {
        (i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)
    }
    flat = whitening.whiten(frame(spark, [(i, [float(i), 0.0]) for i in range(4)])).collect()
    assert {r.component for r in flat if r.whitened is None} == {2}
    large = whitening.whiten(frame(spark, [(1, [3e37, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 7.0])])).collect()
    assert {r.vec_id for r in large} == {1, 2, 3} and any(r.deviation is None for r in large)


def test_query_on_given_vectors(spark):
    sf = f"{DATA}/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(spark, [(r.vec_id, r.embedding) for r in table.collect()], 64)


@pytest.mark.parametrize("d,n", [(1, 12), (6, 200), (12, 5), (20, 400)])
def test_spectra_of_parts_and_of_all(d, n):
    x = np.floor(256 * vectors(n, d, seed=d)).astype(float)
    if d > 5:
        x[:, 3], x[:, 5] = x[:, 2], 0  # equal and empty directions
        x[n // 2 :] = x[: n - n // 2]
    scatter = np.cov(x.T, bias=True).reshape(d, d) * n
    for cuts in ([n], [n // 3, n], [2, n // 2, n - 1, n]):
        whole, a = Spectrum.empty(d), 0
        for b in cuts:
            part = Spectrum.empty(d)
            for row in x[a:b]:
                part.add(row)
            whole.merge(part)
            a = b
        size = np.abs(scatter).max()
        assert np.abs(whole.vectors.T @ whole.vectors - np.eye(d)).max() < 1e-12
        assert np.abs((whole.vectors * whole.values) @ whole.vectors.T - scatter).max() < 1e-11 * size
        assert (np.diff(whole.values) >= 0).all() and whole.n == n
