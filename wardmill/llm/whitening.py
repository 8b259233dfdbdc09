"""Embedding whitening: an incremental eigendecomposition of the covariance.

A spectrum is a count, a mean, and the eigenvalues and eigenvectors of the scatter matrix about it.
Every task runs through its vectors: each one changes the scatter by a rank-one matrix, the vector
less the mean times itself, and the new eigenvalues are the roots of a secular equation. Entries of
the update that are nothing are deflated, and so are equal eigenvalues, by plane rotations. Spectra
of tasks are combined sixteen at a time, level by level, until one is left: the eigenvectors of one,
scaled by their eigenvalues, and the difference of the means are successive rank-one updates of the
other. At last the leading eigenvectors are refined by Rayleigh-Ritz steps over all vectors, until
what is left of V q - e q is rounding only.

Entries are whole numbers (``SCALE`` times the entry, rounded down), so counts, sums and deviations are
exact. The fit list, each distinct vector once, is written with a place for each row; tasks and
levels take it in that order, so that reruns agree. The driver holds one spectrum, of d x (d + 3)
numbers; a row costs of the order of d ** 3 operations.

Defined results: rows whose vector is null or has a null or non-finite entry go; vectors of another
length than the commonest (the longest of equally common ones) go too, as they have no place in the
same space; entries beyond the range of a long are held at its ends. A null vec_id stays, repeated
rows stay and count once in the fit; extra columns are ignored. A vector has as many components as
entries, four at most. A component without variance has no whitened value (null), and with no variance
at all nothing is explained (null). A deviation beyond a long is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.session import stage

SCALE = 256
COMPONENTS = 4
GUARD = 8  # further directions that the refinement carries along
FAN_IN = 16  # spectra or sums combined by one task
STEPS = 40
EPS = float(np.finfo(float).eps)
PLACES = 1 << 33  # rows of a written partition have places within such a range


def secular_roots(d: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Matrix of ``root[j] - d[i]``: the eigenvalues of diag(d) + z z' less each pole.

    ``d`` rises strictly and no ``z`` is 0. Each root is found as its distance from the nearer pole,
    by fitting a function with the two poles beside it, within a bracket that is halved if need be.
    """
    k, z2 = len(d), z * z
    ceiling = d[-1] + z2.sum()
    upper = np.append(d[1:], ceiling)
    gap = upper - d
    i = np.arange(k)
    middle = d[:, None] - d[None, :] - gap[None, :] / 2
    low_half = 1 + (z2[:, None] / middle).sum(axis=0) > 0
    low_half[-1] = True
    origin = np.where(low_half, i, np.minimum(i + 1, k - 1))
    shifted = d[:, None] - d[origin][None, :]  # pole i as seen from the origin of root j
    lo = np.where(low_half, 0.0, -gap / 2)
    hi = np.where(low_half, np.where(i == k - 1, gap, gap / 2), 0.0)
    tau = (lo + hi) / 2
    left = (i[:, None] <= i[None, :]).astype(float)
    right = 1 - left
    for _ in range(STEPS):
        delta = shifted - tau[None, :]
        term = z2[:, None] / delta
        slope = term / delta
        psi, phi, dpsi, dphi = (
            np.einsum("ij,ij->j", a, b) for a in (term, slope) for b in (left, right)
        )
        value = 1 + psi + phi
        size = 1 - psi + phi  # the poles on the left give negative terms only
        lo, hi = np.where(value < 0, tau, lo), np.where(value > 0, tau, hi)
        done = (np.abs(value) <= 2 * k * EPS * size) | (hi - lo <= 2 * EPS * np.abs(tau))
        if done.all():
            break
        near = delta[i, i]
        far = np.where(i < k - 1, delta[np.minimum(i + 1, k - 1), i], np.inf)
        far_ = np.where(i < k - 1, far, 1.0)
        c = np.where(i < k - 1, 1 + psi - near * dpsi + phi - far_ * dphi, 1 + psi - near * dpsi)
        s1, s2 = near * near * dpsi, np.where(i < k - 1, far_ * far_ * dphi, 0.0)
        # c + s1 / (near - t) + s2 / (far - t) = 0
        a = c
        b = np.where(i < k - 1, -(c * (near + far_) + s1 + s2), -(c * near + s1))
        e = np.where(i < k - 1, c * near * far_ + s1 * far_ + s2 * near, 0.0)
        root = np.sqrt(np.maximum(b * b - 4 * a * e, 0))
        big = -(b + np.where(b >= 0, root, -root)) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            first, second = big / a, e / big
            single = near + s1 / c
        tries = [tau + t for t in (second, first)]
        tries[0] = np.where(i == k - 1, tau + single, tries[0])
        step = np.full(k, np.nan)
        for t in reversed(tries):
            inside = np.isfinite(t) & (t > lo) & (t < hi)
            step = np.where(inside, t, step)
        step = np.where(np.isfinite(step), step, (lo + hi) / 2)
        tau = np.where(done, tau, step)
    return tau[None, :] - shifted


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors after ``v v'`` has been added."""
    z = vectors.T @ v
    length = float(z @ z)
    if not length > 0:
        return values, vectors
    tiny = 8 * EPS * max(abs(values[-1]), length)
    small = np.abs(z) * np.sqrt(length) <= tiny
    close = np.diff(values) <= tiny
    if close.any():
        vectors, z = vectors.copy(), z.copy()
        last = -1
        for i in range(len(values)):  # equal eigenvalues: turn the update into one of them
            if small[i]:
                continue
            if last >= 0 and values[i] - values[last] <= tiny:
                r = np.hypot(z[i], z[last])
                c, s = z[i] / r, z[last] / r
                a, b = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
                z[last], z[i] = 0.0, r
                small[last] = True
            last = i
    active = np.flatnonzero(~small)
    if not len(active):
        return values, vectors
    d, w = values[active], z[active]
    over = secular_roots(d, w)  # root j less pole i
    k = len(d)
    # entries that make these roots exact, so that the vectors are orthogonal
    poles = d[None, :] - d[:, None]
    lower = np.where(np.arange(k)[None, :] < np.arange(k)[:, None], poles, np.roll(poles, -1, axis=1))
    lower[:, -1] = 1.0
    exact = np.sqrt(np.abs(np.prod(over / lower, axis=1))) * np.where(w < 0, -1.0, 1.0)
    turned = exact[:, None] / -over
    turned /= np.sqrt((turned * turned).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[active] = d + np.diagonal(over)
    new_vectors[:, active] = vectors[:, active] @ turned
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """Count, mean, and the eigenvalues and eigenvectors of the scatter about it."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def _add(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        self._add(off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        n = self.n + other.n
        off = other.mean - self.mean
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1], strict=True):
            if value > 0:
                self._add(vector * np.sqrt(value))
        self._add(off * np.sqrt(self.n * other.n / n))
        self.n, self.mean = n, self.mean + off * (other.n / n)

    def packed(self) -> list[float]:
        return [float(self.n), *self.mean, *self.values, *self.vectors.ravel()]

    @classmethod
    def unpacked(cls, numbers: np.ndarray, d: int) -> Spectrum:
        return cls(int(numbers[0]), numbers[1 : d + 1], numbers[d + 1 : 2 * d + 1], numbers[2 * d + 1 :].reshape(d, d))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), d)


def _runs(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
    """Rows of one written partition after the other: its first place, and blocks of vectors."""
    place = None
    for batch in batches:
        at = np.asarray(batch.column("place"))
        x = _matrix(batch.column("x"), d)
        cuts = [0, *(np.flatnonzero(np.diff(at // PLACES)) + 1), len(at)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                if place is None or place // PLACES != at[a] // PLACES:
                    place = int(at[a])
                yield place, x[a:b]


def _folded(d: int, start: Callable, add: Callable, done: Callable):
    """Task code: a state for each written partition, fed with blocks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for place, block in _runs(batches, d):
            if place != now:
                if state is not None:
                    yield row(now, state)
                now, state = place, start()
            state = add(state, block)
        if state is not None:
            yield row(now, state)

    def row(place: int, state) -> pa.RecordBatch:
        numbers, whole = done(state)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([place // PLACES]), pa.array([place]),
                pa.array([numbers], pa.list_(pa.float64())), pa.array([whole], pa.list_(pa.string())),
            ],
            ["part", "place", "numbers", "whole"],
        )

    return run


FOLDED = "part long, place long, numbers array<double>, whole array<string>"


def _combined(parts: DataFrame, merge: Callable, label: str):
    """One row from the rows of all partitions, ``FAN_IN`` of them at a time, in their order."""

    def of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        rows = list(zip(group["numbers"], group["whole"], strict=True))
        numbers, whole = rows[0]
        for other in rows[1:]:
            numbers, whole = merge((numbers, whole), other)
        return pd.DataFrame(
            {"part": [int(group["part"].iloc[0])], "place": [int(group["place"].iloc[0])], "numbers": [list(numbers)], "whole": [list(whole)]}
        )

    parts = stage(parts, label)
    last = parts.agg(F.max("part")).first()[0]
    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInPandas(of, FOLDED)
        last //= FAN_IN
        if not last:
            return parts.first()
        parts = stage(parts, label)


def _sum_rows(a, b):
    return (np.add(a[0], b[0]), [str(int(x) + int(y)) for x, y in zip(a[1], b[1], strict=True)])


def whole_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``, the whole numbers of each vector that can be used."""
    e = F.col("embedding")
    odd = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = rows.where(e.isNotNull() & ~odd)
    x = F.transform(e, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _exact_sums(x: np.ndarray) -> tuple[list[int], int]:
    """Sums of the columns, and of all squares, as Python's integers."""
    most = int(max(abs(int(x.max())), abs(int(x.min()))))
    if most * most * x.size >= 2**62:
        x = x.astype(object)
    return [int(s) for s in x.sum(axis=0)], int((x * x).sum())


class Whitening:
    """Mean, components and what they explain, of the fit list of ``rows``."""

    def __init__(self, fit: DataFrame, d: int, most: int = COMPONENTS):
        self.d, self.k = d, min(most, d)

        def start():
            return Spectrum.empty(d), [0] * d, 0

        def add(state, block):
            spectrum, sums, squares = state
            for x in block.astype(float):
                spectrum.add(x)
            more, square = _exact_sums(block)
            return spectrum, [a + b for a, b in zip(sums, more, strict=True)], squares + square

        def done(state):
            return state[0].packed(), [str(s) for s in (*state[1], state[2])]

        def merge(a, b):
            left, right = (Spectrum.unpacked(np.asarray(s[0]), d) for s in (a, b))
            left.merge(right)
            return left.packed(), [str(int(p) + int(q)) for p, q in zip(a[1], b[1], strict=True)]

        folded = fit.mapInArrow(_folded(d, start, add, done), FOLDED)
        numbers, whole = _combined(folded, merge, "spectra")[2:]
        found = Spectrum.unpacked(np.asarray(numbers), d)
        self.n = found.n
        self.sums, squares = [int(s) for s in whole[:-1]], int(whole[-1])
        self.mean = np.array([s / self.n for s in self.sums])
        self.trace = (self.n * squares - sum(s * s for s in self.sums)) / self.n**2
        self.values, self.vectors = self._refined(fit, found.vectors[:, ::-1])
        rank = self.values > 1e-12 * max(self.trace, 0)
        with np.errstate(divide="ignore"):
            self.scale = np.where(rank, 1 / np.sqrt(np.abs(self.values)), np.nan)
        self.explained = self.values / self.trace if self.trace > 0 else np.full(self.k, np.nan)
        self.error = self._identity_error(fit)

    def _refined(self, fit: DataFrame, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        basis = np.linalg.qr(vectors[:, : min(self.d, self.k + GUARD)])[0]
        best = np.inf
        while True:
            image = self._image(fit, basis)
            inner = basis.T @ image
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            ritz, moved = basis @ turn, image @ turn
            left = np.abs(moved - ritz * values)[:, : self.k].max()
            whole = basis.shape[1] == self.d
            if whole or left <= 16 * EPS * self.trace or left > best / 2:
                return values[: self.k], ritz[:, : self.k]
            best = left
            basis = np.linalg.qr(moved)[0]

    def _image(self, fit: DataFrame, basis: np.ndarray) -> np.ndarray:
        """The covariance times the basis, summed over all vectors."""
        mean, shape = self.mean, basis.shape

        def add(total, block):
            off = block - mean
            return total + off.T @ (off @ basis)

        folded = _folded(self.d, lambda: np.zeros(shape), add, lambda s: (list(s.ravel()), []))
        numbers = _combined(fit.mapInArrow(folded, FOLDED), _sum_rows, "ritz")[2]
        return np.asarray(numbers).reshape(shape) / self.n

    def _project(self, off: np.ndarray) -> np.ndarray:
        return (off @ self.vectors) * self.scale

    def _identity_error(self, fit: DataFrame) -> float:
        k, mean, project = self.k, self.mean, self._project

        def add(total, block):
            y = np.nan_to_num(project(block - mean))
            return total + np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

        folded = _folded(self.d, lambda: np.zeros(k + k * k), add, lambda s: (list(s), []))
        total = np.asarray(_combined(fit.mapInArrow(folded, FOLDED), _sum_rows, "identity")[2]) / self.n
        off = total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)
        has = ~np.isnan(self.scale)
        return float(np.abs(off[np.ix_(has, has)]).max(initial=0.0))

    def apply(self, vectors: DataFrame) -> DataFrame:
        """A row for each vector and component."""
        return vectors.mapInArrow(self._rows, RESULT)

    def _rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = self.k, self.n
        for batch in batches:
            x = _matrix(batch.column("x"), self.d)
            if not len(x):
                continue
            reach = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, self.sums))
            if reach < 2**62:
                off = n * x - np.array(self.sums, np.int64)
            else:
                off = n * x.astype(object) - np.array(self.sums, object)
            if reach * reach * self.d < 2**62:
                deviation = (off * off).sum(axis=1).tolist()
            else:
                big = off.astype(object)
                deviation = [v if v < 2**63 else None for v in map(int, (big * big).sum(axis=1))]
            white = self._project(off.astype(float) / n)

            def spread(values, kind, rows=len(x)):
                return pa.array(np.tile(values, rows), kind, from_pandas=True)

            ids = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(ids)), spread(np.arange(1, k + 1, dtype=np.int32), pa.int32()),
                    pa.array(np.full(len(ids), n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(ids)),
                    pa.array(white.ravel(), pa.float64(), from_pandas=True), spread(self.explained, pa.float64()),
                    pa.array(np.full(len(ids), self.error), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, in order, with a place that says where it was written."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = vectors.select("x").distinct().repartition(parts, "x").sortWithinPartitions("x")
    return stage(apart.select(F.monotonically_increasing_id().alias("place"), "x"), "fit-list")


def whiten(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    vectors = whole_vectors(rows)
    common = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    common = common.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None or not common.d:
        return rows.sparkSession.createDataFrame([], RESULT)
    vectors = vectors.where(F.size("x") == common.d)
    return Whitening(fit_list(vectors), common.d).apply(vectors)
