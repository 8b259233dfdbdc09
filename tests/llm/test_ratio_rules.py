from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

from odd import ODD
from oracle import DATA

from wardmill.llm import ratio_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, text string, id long"


def grams(text):
    ids = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in WORD.findall(text or "")]
    return [i % 65_521 for i in ids] + [(a * 1_000_003 + b) % 65_521 for a, b in zip(ids, ids[1:], strict=False)]


def brute(rows, trusted):
    good, all_ = Counter(), Counter()
    for i, text in rows:
        all_.update(grams(text))
        if i in trusted:
            good.update(grams(text))
    sums = {id(c): sum(c.values()) + 65_521 for c in (good, all_)}
    share = lambda c, b: (c[b] + 1) / sums[id(c)]
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        g = grams(text)
        weight = 0
        if sum(good.values()):
            weight = sum(math.floor(65_536 * math.log(share(good, b) / share(all_, b)) + 0.5) for b in g)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        out.append(
            (i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered),
             failed, not failed and weight >= -16_384 * len(g))
        )
    return out


def corpus():
    rng = random.Random(11)
    plain, junk = [f"wort{i}é" for i in range(60)], [f"x{i}$&" for i in range(60)]
    rows = []
    for i in range(80):
        vocabulary = junk if i % 5 == 0 else plain
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))]
        if i % 7 == 0:
            words = words[:15] * 5
        rows.append((i, "".join(w + rng.choice((" ", "\n", "\t")) for w in words)))
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, rows[1][1]), rows[2]]
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(i, q, "t", 1) for i, q in rows], LABELS)


def judged(docs, marks):
    rows = ratio_rules.judge(docs, marks).drop("digest", "n_grams", "score").collect()
    return sorted(map(tuple, rows), key=str)


def test_counts_and_verdicts_against_plain_code(spark, documents):
    rows = corpus()
    marks = [(i, 0 if i % 5 == 0 else 1) for i in range(70)] + [(3, 0), (None, 1), (4, None), (9, 7), (999_999, 1)]
    trusted = {i for i in range(70) if i % 5} - {3} | {999_999}
    got = judged(documents(rows), labels(spark, marks))
    assert got == sorted(brute(rows, trusted), key=str)
    kept = {r[0] for r in got if r[-1]}
    assert kept and not any(i is not None and i < 70 and i % 5 == 0 for i in kept)


def test_accepted_rows_stay_as_they_are(spark, documents):
    rows = corpus()
    docs, marks = documents(rows), labels(spark, [(i, int(i % 5 > 0)) for i in range(70)])
    kept = ratio_rules.accepted(docs, marks)
    assert kept.columns == docs.columns
    verdicts = ratio_rules.judge(docs, marks).where("kept").select("doc_id").collect()
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in verdicts)


def test_without_labels_and_without_documents(spark, documents):
    rows = corpus()
    assert judged(documents(rows), labels(spark, [])) == sorted(brute(rows, set()), key=str)
    assert ratio_rules.judge(documents(rows).limit(0), labels(spark, [(1, 1)])).collect() == []


def test_trusted_documents_are_bounded_and_the_same(spark):
    marks = labels(spark, [(i, 1) for i in range(50)])
    first, again = ({r.id for r in ratio_rules.trusted_ids(marks, 10).collect()} for _ in "ab")
    assert len(first) == 10 and first == again


def test_good_documents_stay_and_junk_goes(spark):
    sf = f"{DATA}/sf0.01"
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = ratio_rules.judge(docs, marks).join(marks, "doc_id").where("NOT base_failed").collect()
    for quality, least, most in ((1, 0.99, 1), (0, 0, 0.1)):
        kept = [r.kept for r in found if r.quality == quality]
        assert least <= sum(kept) / len(kept) <= most
