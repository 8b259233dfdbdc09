from __future__ import annotations

import itertools
import math
import random
import re

import pytest
from odd import ODD

from wardmill.llm import decontaminate as d


def norm(text):
    return [w.lower() for w in re.findall(r"[\u4e00-\u9fff]|[^\W_\u4e00-\u9fff]+", text or "")]


def brute(texts, items, window=20, share=0.8):
    """(doc, item, doc_start, best) of every offset at which enough words agree."""
    found = set()
    for (i, t), (j, b) in itertools.product(enumerate(texts), enumerate(items)):
        a, b = norm(t), norm(b)
        if not b:
            continue
        size = min(len(b), window)
        needed = len(b) if len(b) < d.LEAST else math.ceil(round(size * share, 6))
        for start in range(-len(b) + 1, len(a)):
            lo, hi = max(0, -start), min(len(b), len(a) - start)
            if hi - lo < size:
                continue
            equal = [a[start + k] == b[k] for k in range(lo, hi)]
            best = max(sum(equal[k : k + size]) for k in range(hi - lo - size + 1))
            if best >= needed:
                found.add((i, j, start + lo, best))
    return found


def bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def got(docs, benchmark):
    rows = d.contaminated(docs, benchmark).collect()
    return {(r.id, r.item_id, r.doc_start, r.best) for r in rows}


def test_masks_meet_all_replacements():
    """What the module says about its masks, by trial of all patterns."""
    for size, wrong in ((8, 1), (10, 2), (12, 2), (15, 3), (20, 4)):
        for bad in itertools.combinations(range(size), wrong):
            assert any(
                all(p + o not in bad for o in mask)
                for mask in d.MASKS
                for p in range(size - mask[-1])
            )


def cases():
    rng = random.Random(11)
    common = [f"t{i}" for i in range(30)]
    items = [" ".join(rng.choice(common) + str(rng.randrange(40)) for _ in range(n)) for n in (5, 8, 9, 12, 20, 33, 60)]
    items.append(items[4])
    texts = []
    for _ in range(200):
        words = [rng.choice(common) + str(rng.randrange(40)) for _ in range(rng.randrange(60))]
        part = rng.choice(items).split()
        a = (rng.random() < 0.3) * rng.randrange(len(part))
        part = part[a : a + rng.choice((8, 20, 60))]
        for k in rng.sample(range(len(part)), min(len(part), rng.choice((0, 1, 2, 3, 8)))):
            part[k] = "new"
        at = rng.randrange(len(words) + 1)
        text = words[:at] + [w.upper() + rng.choice((",", "", ".")) for w in part] + words[at:]
        texts.append(rng.choice((" ", "\n")).join(text))
    return texts, items


def test_against_all_offsets(documents, spark):
    texts, items = cases()
    expected = brute(texts, items)
    assert 30 < len({x[0] for x in expected}) < 180
    assert got(documents(texts), bench(spark, items)) == expected
    clean = {r.doc_id for r in d.clean(documents(texts), bench(spark, items)).collect()}
    assert clean == set(range(len(texts))) - {x[0] for x in expected}


def test_same_without_broadcast(documents, spark, monkeypatch):
    texts, items = cases()
    monkeypatch.setattr(d, "BROADCAST_SEEDS", 0)
    assert got(documents(texts), bench(spark, items)) == brute(texts, items)


def test_short_items_and_scripts_without_blanks(documents, spark):
    rng = random.Random(3)
    han = [chr(0x4E00 + i) for i in range(40)]
    items = ["a", "B c", "a b c d e f g", "中文", "".join(han[:9]), "".join(han[5:30]), "x" + han[3] + "y z", "_ ,"]
    texts = []
    for _ in range(120):
        words = [rng.choice(("a ", "b ", "c ", "d ", *han[:8])) for _ in range(rng.randrange(12))]
        part = list(rng.choice(items).upper())
        for k in rng.sample(range(len(part)), min(len(part), rng.choice((0, 0, 1, 4)))):
            part[k] = rng.choice(han)
        texts.append("".join(words) + " " + "".join(part) + " " + "".join(words[::-1]))
    expected = brute(texts, items)
    assert {j for _, j, _, _ in expected} == {0, 1, 2, 3, 4, 5, 6}
    assert got(documents(texts), bench(spark, items)) == expected


@pytest.mark.parametrize("items", [[], [None, "", "a b c"], ["w " * 25]])
def test_odd_texts_and_items(documents, spark, items):
    docs, benchmark = documents(ODD), bench(spark, items)
    found = {r.id for r in d.contaminated(docs, benchmark).collect()}
    assert found == ({8} if items[:1] == ["w " * 25] else set())
    assert d.clean(docs, benchmark).columns == docs.columns
    assert d.clean(docs, benchmark).count() == len(ODD) - len(found)


def test_repeated_rows_null_ids_and_nothing(documents, spark):
    item = "one two three four five six seven eight nine ten"
    docs = documents([(1, item), (1, item), (None, item), (2, "x")])
    assert got(docs, bench(spark, [item])) == {(1, 0, 0, 10), (None, 0, 0, 10)}
    assert [r.doc_id for r in d.clean(docs, bench(spark, [item])).collect()] == [2]
    assert got(docs.limit(0), bench(spark, [item])) == set()
