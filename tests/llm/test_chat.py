from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from oracle import DATA
from pyspark.sql import functions as F

from wardmill.llm import chat
from wardmill.llm.quality import held_out


def model(seed=0):
    rng = np.random.default_rng(seed)
    step, seen = np.log(rng.random((chat.STATES + 1, chat.STATES))), np.log(rng.random((chat.STATES, chat.CODES)))
    step[chat.START, 1::2] = -np.inf
    return chat.Model(step, seen)


def score(m, codes, path):
    before, total = chat.START, 0.0
    for c, s in zip(codes, path, strict=True):
        total += m.step[before, s] + m.seen[s, c]
        before = s
    return total


def test_best_path_against_all_paths():
    rng = random.Random(1)
    m = model()
    for n in (1, 2, 5):
        codes = [rng.randrange(chat.CODES) for _ in range(n)]
        best = max(itertools.product(range(chat.STATES), repeat=n), key=lambda p: score(m, codes, p))
        matrices = m.matrices(np.array(codes))
        assert tuple(chat._best_path(matrices, chat.START, best[-1])) == best
        assert np.isclose(chat._product(matrices)[chat.START].max(), score(m, codes, best))


def viterbi(m, codes):
    """In one go over all lines."""
    total, back = m.step[chat.START] + m.seen[:, codes[0]], []
    for c in codes[1:]:
        ways = total[:, None] + m.step[: chat.STATES] + m.seen[None, :, c]
        back.append(ways.argmax(axis=0))
        total = ways.max(axis=0)
    path = [int(total.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


@pytest.mark.parametrize("block", [2, 3, 512])
def test_blocks_agree_with_one_go(spark, monkeypatch, block):
    """Long and short transcripts, over several levels of blocks."""
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(block)
    texts = ["User: hi?", "Assistant: well", "more words follow here", "", "Q: a b c d e f g?", "[agent] ok", None]
    lines = [(c, i, rng.choice(texts)) for c, n in ((1, 40), (2, 1), (None, 9), (4, 3)) for i in range(n)]
    df = spark.createDataFrame(lines, "conv long, seq long, line string")
    m = model(block)
    codes = {(r.conv, r.seq): r.code for r in df.fillna({"line": ""}).select("conv", "seq", chat.code("line").alias("code")).collect()}
    expected = set()
    for conv in (1, 2, None, 4):
        own = [(k[1], v) for k, v in codes.items() if k[0] == conv]
        path = viterbi(m, [c for _, c in sorted(own)])
        turn, sizes = -1, []
        for s in path:
            if s % 2 == 0:
                turn += 1
                sizes.append([s // 2, 0])
            sizes[-1][1] += 1
        expected |= {(conv, t, chat.ROLES[r], n) for t, (r, n) in enumerate(sizes)}
    got = {(r.conv, r.turn, r.role, r.text.count("\n") + 1) for r in chat.decode(df, m).collect()}
    assert got == expected


def test_held_out_roles_are_recovered(spark):
    conversations = spark.read.parquet(str(DATA / "sf0.01" / "conversations.parquet"))
    raw = chat.raw_lines(conversations)
    found = chat.decode(raw.where(held_out(raw["conv"])), chat.train(raw.where(~held_out(raw["conv"]))))
    truth = {(r.conv_id, r.turn): (r.role, r.text.strip()) for r in conversations.collect()}
    got = {(r.conv, r.role, r.text.strip()) for r in found.collect()}
    convs = {c for c, _, _ in got}
    known = [(c, *v) for (c, _), v in truth.items() if c in convs]
    assert len(known) > 50
    assert sum(k in got for k in known) / len(known) > 0.75


def test_labels_without_noise_come_back_whole(spark, monkeypatch):
    """If every turn has its marker, all turns are read as they were."""
    monkeypatch.setattr(chat, "UNMARKED", 10**9)
    conversations = spark.read.parquet(str(DATA / "sf0.01" / "conversations.parquet"))
    raw = chat.raw_lines(conversations)
    found = {(r.conv, r.turn, r.role, r.text.strip()) for r in chat.decode(raw, chat.train(raw)).collect()}
    truth = {(r.conv_id, r.turn, r.role, r.text.strip()) for r in conversations.collect()}
    assert len(found & truth) / len(truth) > 0.98


def test_nulls_repeated_rows_and_nothing(spark):
    rows = [(None, 0, "user", "hi"), (1, 0, None, None), (1, 0, None, None), (1, None, "user", "x"), (2, 0, "robot", "")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    raw = chat.raw_lines(given)
    assert {r.conv for r in chat.decode(raw, chat.train(raw)).collect()} == {None, 1, 2}
    empty = chat.raw_lines(given.limit(0))
    assert chat.decode(empty, chat.train(empty)).count() == 0
    long = spark.createDataFrame([(1, 0, "user", "word " * 50_000 + "\n" * 5000)], given.schema)
    assert chat.decode(chat.raw_lines(long), chat.train(raw)).agg({"turn": "max"}).first()[0] is not None


def test_a_turn_renders_in_one_way(spark):
    """A break after a marker on its own line, and blanks around a text, are no part of it."""
    texts = ["hi\n there", "\nhi\n there", " \n\thi\n there \r\n\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r[0] for r in df.select(chat.rendered(F.lit("user"), F.col("text"))).collect()}
    assert got == {"<|user|>\nhi\n there\n<|end|>\n"}
    lines = [(1, i, line) for i, line in enumerate(["### Instruction:", "sum this", "### Response:", "", "done", ""])]
    raw = spark.createDataFrame(lines, "conv long, seq long, line string")
    conversations = spark.read.parquet(str(DATA / "sf0.01" / "conversations.parquet"))
    turns = chat.decode(raw, chat.train(chat.raw_lines(conversations)))
    assert [r[0] for r in turns.orderBy("turn").select(chat.bare(F.col("text"))).collect()] == ["sum this", "done"]
