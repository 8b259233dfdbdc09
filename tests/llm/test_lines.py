from __future__ import annotations

import random
import re

from odd import ODD

from wardmill.llm import line_dedup


def near(a: str, b: str) -> bool:
    """Whether one edit turns a into b."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(texts):
    """Positions of removed lines of each text."""
    seen, gone = [], []
    for text in texts:
        out = set()
        for pos, line in enumerate((text or "").split("\n")):
            if not re.search(r"[^\x20\x09-\x0D]", line):
                continue
            if any(line == s or (min(len(line), len(s)) >= 20 and near(line, s)) for s in seen):
                out.add(pos)
            seen.append(line)
        gone.append(out)
    return gone


def edited(line: str, rng: random.Random) -> str:
    i, kind = rng.randrange(len(line)), rng.randrange(3)
    return line[:i] + ("", "x", "é")[rng.randrange(3)] * (kind < 2) + line[i + (kind != 1) :]


def cases():
    rng = random.Random(7)
    base = ["".join(rng.choice("ab é\U0001f600") for _ in range(rng.randrange(15, 45))) + "." for _ in range(60)]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rng.randrange(5)):
            line = rng.choice(base)
            for _ in range(rng.randrange(3)):
                line = edited(line, rng)
            lines.append(line)
        texts.append("\n".join([*lines, *[""] * rng.randrange(2)]))
    return texts


def test_against_all_pairs(documents):
    texts = cases()
    expected = brute(texts)
    assert sum(map(len, expected)) > 100
    for r in line_dedup.line_counts(documents(texts)).collect():
        lines, gone = texts[r.doc_id].split("\n"), expected[r.doc_id]
        assert (r.n_lines, r.n_removed) == (len(lines), len(gone)), texts[r.doc_id]
        assert r.kept == "\n".join(line for i, line in enumerate(lines) if i not in gone)


def test_every_edit_of_one_line_is_found(documents):
    line = "The quick brown fox jumps over it"
    edits = [line[:i] + line[i + 1 :] for i in range(len(line))]
    edits += [line[:i] + "é" + line[i:] for i in range(len(line) + 1)]
    edits += [line[:i] + "é" + line[i + 1 :] for i in range(len(line))]
    rows = line_dedup.line_counts(documents([line, *edits, line + "##", "#" + line + "#"])).collect()
    removed = brute([line, *edits, line + "##", "#" + line + "#"])
    assert {r.doc_id: r.n_removed for r in rows} == {i: len(g) for i, g in enumerate(removed)}


def test_odd_texts(documents):
    texts = [*ODD, "b" * 25_000 + "\n" + "b" * 25_001, "short\nshort\nshorts"]
    expected = brute(texts)
    docs = documents(texts)
    for r in line_dedup.line_counts(docs).collect():
        assert r.n_removed == len(expected[r.doc_id])
    kept = {r.doc_id: r for r in line_dedup.dedup(docs).collect()}
    assert kept[0].text is None and kept[1].text == "" and kept[2].text == " \n\t "
    assert 4 not in kept and kept[10].text == "short\nshorts" and kept[10].n_chars == 12
    assert line_dedup.dedup(docs).columns == docs.columns


def test_repeated_rows_nulls_and_nothing(documents):
    docs = documents([(1, "same line of text here"), (1, "same line of text here"), (None, "x\nx")])
    rows = sorted(map(tuple, line_dedup.line_counts(docs).drop("kept").collect()), key=str)
    assert rows == [(1, 1, 0), (1, 1, 0), (None, 2, 1)]
    assert line_dedup.line_counts(docs.limit(0)).count() == 0


def test_an_earlier_permuted_line_hides_no_near_line(documents):
    """Lines with the same pairs of neighbours in another order are no partners of one key."""
    rng = random.Random(9)
    texts = []
    for start, end in (("Answer key of part two, row:", ""), ("", "of the answer key, by row.")):
        for _ in range(3):
            cells = [rng.choice("ABCD") for _ in range(12)]
            permuted = cells[:]
            while near("".join(permuted), "".join(cells)):
                rng.shuffle(permuted)
            for last in (permuted, cells, [*cells[:4], "X", *cells[5:]], [*cells[:7], "YZ", *cells[8:]]):
                texts.append(" ".join([start, *last, end]))
    texts += [f"Answer key of part two, row: {row}" for row in ("B D C A", "B D C X", "B C D X", "B C D Y")]
    for row in ("B D C A", "D C B A", "C B D A", "B C D A", "D B C A", "B D A C"):
        texts += [f"Answer key of part two, row: {row} {end}" for end in "XYZ"]
        texts += [f"Answer key of part two, row: {row[:3]}{row[4:]} W"]
    rng.shuffle(texts)
    for order in (texts, texts[::-1]):
        rows = line_dedup.line_counts(documents(order)).collect()
        assert {r.doc_id: r.n_removed for r in rows} == {i: len(g) for i, g in enumerate(brute(order))}
