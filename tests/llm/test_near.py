from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from odd import ODD

from wardmill.llm import near_dedup
from wardmill.llm.common import WordHashes, word_chunks
from wardmill.llm.components import components


def shingles(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(texts, size=4):
    sets = [shingles(t, size) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def cases(n=300):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(2, 120))] for _ in range(40)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 2, 4, 8))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
        texts.append(rng.choice((" ", "\n", "  ")).join(words))
    # a chain whose ends are unlike each other
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for i in range(12):
        chain = chain[4:] + [rng.choice(vocabulary) for _ in range(4)]
        texts.append(" ".join(chain))
    return texts


def test_groups_against_all_pairs(documents):
    texts = cases() + ODD
    expected = brute(texts)
    assert len({c for _, c in expected}) < len(texts) - 100
    for r in near_dedup.group(documents(texts), shingle=4).collect():
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_links_beyond_the_leader_are_found(documents):
    """Members alike to each other but not to the smallest of their group."""
    words = [f"v{i}" for i in range(200)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 60, 3)]
    random.Random(1).shuffle(texts)
    expected = brute(texts)
    got = {r.doc_id: r.component_id for r in near_dedup.group(documents(texts), shingle=4).collect()}
    assert got == {i: c for i, (_, c) in enumerate(expected)}


def test_dedup_keeps_one_row_of_each_group(documents):
    texts = cases(80)
    docs = documents(texts)
    kept = near_dedup.dedup(docs, shingle=4)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in brute(texts)}


def test_rows_without_id_repeated_rows_and_nothing(documents):
    docs = documents([(3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (9, "a b c d e")])
    rows = {tuple(r) for r in near_dedup.group(docs).drop("digest").collect()}
    assert rows == {(3, 1, 3, True), (None, 1, None, True), (9, 1, 3, False)}
    assert near_dedup.group(docs.limit(0)).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    for n in (5, 40, 700):
        both = rng.integers(1, 2**63, 2 * n).astype(np.uint64)
        for shared in (0, n // 2, n):
            a, b = both[:n], np.concatenate([both[:shared], both[n : 2 * n - shared]])
            owners = np.repeat([0, 1], [len(a), len(b)])
            sig = near_dedup.super_minhash(owners, np.concatenate([a, b]), 2, 128)
            true = shared / (2 * n - shared)
            assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / 128) ** 0.5 + 1e-9
            assert (sig < near_dedup.EMPTY).all()


def test_signature_does_not_depend_on_its_batch():
    texts = cases(30)
    known = WordHashes()

    def signed(part):
        out = []
        for _, flat, lengths in word_chunks(part, known, lower=True):
            owners, hashes = near_dedup.shingle_sets(flat, lengths, 5)
            out.append(near_dedup.super_minhash(owners, hashes, len(lengths)))
        return np.concatenate(out)

    assert (signed(texts) == np.concatenate([signed([t]) for t in texts])).all()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 300)]
    links += [(5000 + rng.randrange(200), 5000 + rng.randrange(200)) for _ in range(120)]
    rng.shuffle(links)
    label: dict = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {x: root(x) for x in label if root(x) != x}


def test_two_texts_under_one_id_in_any_order(documents):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    x, y = (" ".join(rng.choice(words) for _ in range(80)) for _ in "xy")
    near_x = x.rsplit(" ", 1)[0] + " other"
    for rows in ([(5, x), (5, y), (6, near_x)], [(5, y), (5, x), (6, near_x)]):
        got = {(r.doc_id, r.component_id) for r in near_dedup.group(documents(rows)).collect()}
        assert got == {(5, 5), (6, 5)}
    rows = [(3, x), (5, x), (5, y), (7, y), (9, "a b c d e f g")]
    for _ in range(2):
        got = {(r.doc_id, r.component_id) for r in near_dedup.group(documents(rows)).collect()}
        assert got == {(3, 3), (5, 3), (7, 3), (9, 9)}
        rows.reverse()


def test_a_large_half_alike_template(documents, monkeypatch):
    """Members share a template of half their shingles; few are linked, none of them is lost."""
    rng = random.Random(6)
    template = [f"t{i}" for i in range(60)]
    texts = []
    for i in range(120):
        own = [f"o{i}_{k}" for k in range(rng.choice((30, 45)))]
        texts.append(" ".join(template + own))
        if i % 10 == 0:
            own[-3:] = ["x", "y", "z"]
            texts.append(" ".join(template + own))
    rng.shuffle(texts)
    compared = []
    plain = near_dedup._verified

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.group(documents(texts), shingle=4).collect()}
    assert got == {i: c for i, (_, c) in enumerate(brute(texts))}
    # the pairs after the first ones follow the links, not the square of the group
    assert sum(compared[1:]) <= 2 * len(texts)


def test_filed_sets_share_a_key(spark):
    """Sets just at the similarity have one of the shingles they are filed under in common."""
    rng = np.random.default_rng(2)

    class Value:
        value = rng.integers(0, 50, near_dedup.CELLS)

    for n in (1, 2, 5, 9, 40, 333):
        for m in range(-(-80 * n // 100), n + 1):
            common = rng.choice(2**60, m, replace=False)
            a = np.unique(np.concatenate([common, rng.choice(2**60, n - m)]))
            batch = pa.RecordBatch.from_arrays(
                [pa.array([1, 2]), pa.array([a.tolist(), np.unique(common).tolist()])], ["rep", "grams"]
            )
            one, two = near_dedup._filed(Value, 80)(iter([batch]))
            assert set(one.column("key").to_pylist()) & set(two.column("key").to_pylist())


def test_many_members_around_the_similarity(documents, monkeypatch):
    """Versions of one text that are linked to few of the others, whatever keys they carry along."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(70)]
    texts = []
    for i in range(90):
        words = list(base)
        for at in rng.sample(range(70), rng.choice((2, 3, 3, 4))):
            words[at] = f"n{i}_{at}" if rng.random() < 0.7 else f"n{at}"
        texts.append(" ".join(words))
    expected = {i: c for i, (_, c) in enumerate(brute(texts))}
    assert len(set(expected.values())) > 10
    for head in (32, 1):
        monkeypatch.setattr(near_dedup, "HEAD", head)
        got = near_dedup.group(documents(texts), shingle=4).collect()
        assert {r.doc_id: r.component_id for r in got} == expected
