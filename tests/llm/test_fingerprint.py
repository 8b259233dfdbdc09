from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash
from odd import ODD

from wardmill.llm import fingerprint as f
from wardmill.llm.common import keyed

SEED, MASK = 42, (1 << f.PLACE_BITS) - 1


def h(*values) -> int:
    """Spark's xxhash64: each value is hashed with the hash before it as seed; null is skipped."""
    out = SEED
    for v in values:
        if isinstance(v, str):
            out = xxhash.xxh64_intdigest(v.encode(), out)
        elif v is not None:
            size = 4 if isinstance(v, Int) else 8
            out = xxhash.xxh64_intdigest((int(v) % 2 ** (8 * size)).to_bytes(size, "little"), out)
    return out


class Int(int):
    """A 32-bit value."""


def sketch(text) -> dict:
    """Bin to the hash of its tuple."""
    words = [h(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    grams = [words[i : i + f.K] for i in range(max(len(words) - f.K + 1, 1))] if words else []
    seen, bins = Counter(), {}
    for place, gram in enumerate(grams):
        short = h(*gram) >> 29
        numbered = h(short, Int(seen[short])) >> 29
        seen[short] += 1
        bins.setdefault(numbered >> (35 - f.BIN_BITS), []).append((numbered, place))
    ring = sorted(m for members in bins.values() for m in members)
    out = {}
    for b in range(f.BINS if ring else 0):
        at = sum(n >> (35 - f.BIN_BITS) < b for n, _ in ring)
        two = [ring[i % len(ring)] for i in range(at, at + min(2, len(ring)))]
        out[b] = h(*[n for n, _ in sorted(two, key=lambda m: m[1])]) >> 32
    return out


def written(s: dict) -> str:
    return "".join(f"{(b << 32 | v):010X}" for b, v in sorted(s.items()))


def likeness(a: dict, b: dict) -> float:
    either = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in either) / len(either) if either else 1.0


def check(rows, ordered):
    """Each row against the plain computation; ``ordered`` are (doc_id, text) in order."""
    texts = [t or "" for _, t in ordered]
    expected = []
    for i, (doc_id, _) in enumerate(ordered):
        own, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        a, b, c = sketch(own), sketch(edited), sketch(after)
        expected.append(
            (doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b),
             likeness(a, b), likeness(a, c))
        )
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_against_plain_computation(documents):
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(250))) for _ in range(60)]
    texts += [*texts[:5], *ODD[:7], "rep " * 500]
    ids = rng.sample(range(-500, 5000), len(texts))
    docs = documents(list(zip(ids, texts, strict=True)))
    check(f.compare(docs).collect(), sorted(zip(ids, texts, strict=True)))


def test_one_document_is_its_own_next(documents):
    check(f.compare(documents([(5, "a b c d e f")])).collect(), [(5, "a b c d e f")])
    assert f.compare(documents(["x"]).limit(0)).count() == 0


def test_long_texts_null_ids_and_repeated_rows(documents):
    docs = documents([(None, "n n"), (1, "w " * 30_000), (2, "same text"), (2, "same text"), (3, None)])
    rows = f.compare(docs).collect()
    assert len(rows) == 5 and {r.near_next for r in rows if r.doc_id == 3} == {0.0}
    assert any(r.doc_id == 2 and r.near_next == 1.0 for r in rows)


def test_order_matters_and_edits_lower_the_likeness(documents, spark):
    rng = random.Random(9)
    words = [f"x{rng.randrange(5000)}" for _ in range(3000)]
    blocks = [words[i : i + 100] for i in range(0, 3000, 100)]
    rng.shuffle(blocks)
    variants = [words, words[:1400] + ["new"] * 5 + words[1400:], words[:1500] + words[:1500], sum(blocks, [])]
    docs = documents([" ".join(v) for v in variants])
    rows = {r.id: r.s for r in keyed(docs).select("id", f.sketch("body").alias("s")).collect()}

    def like(i):
        a, b = ({v >> 32: v for v in rows[j]} for j in (0, i))
        return likeness(a, b)

    assert like(1) > 0.85 > 0.6 > like(2)
    # nearly all k-mers are the same, but blocks have swapped places
    assert 0.2 < like(3) < 0.8


def test_swapped_halves_of_short_texts_are_unlike(documents):
    rng = random.Random(3)
    for size in (20, 40, 80, 240):
        texts = [[f"y{rng.randrange(10**6)}" for _ in range(size)] for _ in range(40)]
        docs = documents([" ".join(v) for t in texts for v in (t, t[size // 2 :] + t[: size // 2])])
        rows = {r.id: r.s for r in keyed(docs).select("id", f.sketch("body").alias("s")).collect()}
        first = min(rows)
        pairs = [(rows[first + i], rows[first + i + 1]) for i in range(0, 80, 2)]
        mean = sum(len({*a} & {*b}) / f.BINS for a, b in pairs) / len(pairs)
        assert 0.1 < mean < 0.6, (size, mean)


def test_an_id_of_most_rows_is_split(documents, spark):
    rng = random.Random(8)
    rows = [(7, f"text {rng.random()} of one id") for _ in range(300)]
    rows += [(i, f"other {i} text here") for i in range(60)] + [(None, f"null {i}") for i in range(90)]
    placed = f.with_next(documents(rows), {})
    assert placed.count() == len(rows) and placed.where("next_body IS NULL").count() == 0
    signed = {t: (h("body", t) + 2**63) % 2**64 - 2**63 for _, t in rows}
    ordered = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], signed[r[1]]))
    follows = {t: ordered[(i + 1) % len(rows)][1] for i, (_, t) in enumerate(ordered)}
    assert {r.body: r.next_body for r in placed.collect()} == follows
    # adaptive execution would merge partitions as small as these
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for n in f.with_next(documents(rows), {}).rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < len(rows) / 2
