from __future__ import annotations

import hashlib
import random

import numpy as np
from odd import ODD

from wardmill.llm import substring_dedup as s


def brute(texts):
    first, rows = {}, []
    words = [(t or "").replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
    words = [[w for w in ws if w] for ws in words]
    for ws in words:
        gone = [False] * len(ws)
        for i in range(len(ws) - s.WINDOW + 1):
            window = tuple(ws[i : i + s.WINDOW])
            if window in first:
                gone[i : i + s.WINDOW] = [True] * s.WINDOW
            first.setdefault(window, i)
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        rows.append((len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return rows


def cases():
    rng = random.Random(8)
    texts = []
    passages = [[f"p{rng.randrange(90)}" for _ in range(n)] for n in (19, 20, 21, 45, 80)]
    for _ in range(250):
        words = [rng.choice("abc") if rng.random() < 0.02 else f"v{rng.randrange(9999)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, at = rng.randrange(3), rng.randrange(len(words) + 1)
            words[at:at] = p[a:] if rng.random() < 0.5 else p + p
        if rng.random() < 0.1:
            words += ["x"] * rng.randrange(70)
        texts.append(rng.choice((" ", "\n", "\t ")).join(words))
    return [*texts, *texts[:20]]


def test_against_all_windows(documents):
    texts = cases()
    expected = brute(texts)
    assert sum(r[1] for r in expected) > 5000
    rows = s.dedup(documents(texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == dict(enumerate(expected))


def test_a_full_sketch_loses_nothing(documents, monkeypatch):
    """With few cells nearly all windows pass the filter; the result is the same."""
    monkeypatch.setattr(s, "SHARD", 64)
    monkeypatch.setattr(s, "LEAST_CELLS", 128)
    monkeypatch.setattr(s, "MOST_CELLS", 128)
    monkeypatch.setattr(s, "FLUSH", 50)
    texts = cases()
    rows = s.dedup(documents(texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == dict(enumerate(brute(texts)))


def test_odd_texts_repeated_rows_and_nothing(documents):
    texts = [*ODD, " ".join(map(str, range(20))), " ".join(map(str, range(20)))]
    rows = s.dedup(documents(texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == dict(enumerate(brute(texts)))
    long = " ".join(map(str, range(30)))
    rows = s.dedup(documents([(5, long), (5, long), (None, long)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (5, 30), (5, 30)]
    assert s.dedup(documents(["x"]).limit(0)).count() == 0


def test_estimates_are_never_below_the_truth():
    """Every window that occurs twice has an anchor chosen at two places or more."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        part = rng.integers(1, 4, 26).astype(np.uint64)
        flat = np.concatenate([rng.integers(1, 4, 30).astype(np.uint64), part, rng.integers(1, 4, 9).astype(np.uint64), part])
        lengths = np.array([rng.integers(0, len(flat)), 0])
        lengths[1] = len(flat) - lengths[0]
        low, inside, _ = s._anchors(flat, lengths)
        values, counts = np.unique(s._chosen(flat, low, inside), return_counts=True)
        chosen = dict(zip(values.tolist(), counts.tolist(), strict=True))
        windows: dict = {}
        for p in np.flatnonzero(inside):
            windows.setdefault(tuple(flat[p : p + s.WINDOW]), []).append(p)
        for places in windows.values():
            assert chosen[int(low[places[0]])] >= len(places)


def test_the_text_that_is_left_is_given(documents):
    """Also where the texts of a batch make several chunks."""
    texts = [*cases(), *ODD, "é \U0001f600\tz", " ".join(f"w{i}" for i in range(140_000)), "after it"]
    rows = {r.doc_id: r for r in s.dedup(documents(texts)).collect()}
    for i, (n_words, n_removed, digest) in enumerate(brute(texts)):
        r = rows[i]
        assert (r.n_words, r.n_removed) == (n_words, n_removed)
        assert hashlib.sha256(r.kept.encode()).hexdigest() == digest == r.kept_sha256
        assert len(r.kept.split()) == n_words - n_removed
    assert rows[len(texts) - 3].kept == "é \U0001f600 z" and rows[len(texts) - 1].kept == "after it"
