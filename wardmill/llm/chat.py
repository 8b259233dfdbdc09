"""Chat formatting: roles of raw transcripts by a hidden Markov model, then canonical turns.

A transcript is a sequence of lines. The hidden state of a line is a role together with whether
the line begins a turn; what is seen of it is a speaker marker, its length, and how it ends. Counts
over labelled transcripts give the model, and Viterbi's algorithm the most likely states, so a
turn without a marker, or with one that is used for another role, is read from its surroundings.

No transcript has to fit into one task. Lines are dealt into blocks of ``BLOCK``; each block is
reduced to one matrix, the best score from any state before it to any at its end, and blocks of
matrices are reduced in the same way until one is left for a transcript. The best last state then
goes down the same levels, fixing the states at the ends of ever smaller blocks, and at last of
each line. Only a turn itself is put together as a whole, as the text that it is.

Defined results: a null line is an empty one; transcripts with a null id are one transcript;
repeated lines at one place follow each other; an empty table gives no turns; a line whose marker
is unknown counts as one without; without labelled lines all paths are equally likely, and every
line is read as the first state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.common import prefix_sums
from wardmill.session import stage

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role begins a turn, 2 * role + 1 goes on
START = STATES  # the state before the first line
BLOCK = 512
# Words that are used as speaker markers.
MARKERS = (
    "system", "user", "human", "prompter", "question", "q", "instruction", "customer",
    "assistant", "ai", "bot", "model", "answer", "a", "response", "agent",
)
LENGTHS = 6
CODES = (len(MARKERS) + 1) * LENGTHS * 2
_MARKER = r"(?i)^[\s#*\[(<|]*(" + "|".join(MARKERS) + r")[\])>|*]*\s*(?::|\]|>|\|)+\**\s*"


def marker(line: Column) -> Column:
    """Index of the marker that a line starts with, counted from 1, or 0."""
    found = F.lower(F.regexp_extract(line, _MARKER, 1))
    return F.coalesce(F.array_position(F.lit(list(MARKERS)), found), F.lit(0)).cast("int")


def code(line: Column) -> Column:
    """What the model sees of a line, as one number."""
    count = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    length = F.least(F.lit(LENGTHS - 1), F.floor(F.log2(count + 1.0))).cast("int")
    asks = F.rtrim(line).endswith("?").cast("int")
    return (marker(line) * LENGTHS + length) * 2 + asks


@dataclass(frozen=True)
class Model:
    """Log probabilities: ``step[from, to]`` with ``START`` as a first state, ``seen[state, code]``."""

    step: np.ndarray
    seen: np.ndarray

    def matrices(self, codes: np.ndarray) -> np.ndarray:
        """For each line, scores from the state before (or the start) to the line's own state."""
        out = np.full((len(codes), STATES + 1, STATES + 1), -np.inf)
        out[:, :, :STATES] = self.step[None, :, :] + self.seen[:, codes].T[:, None, :]
        return out


def _best_path(matrices: np.ndarray, first: int, last: int) -> np.ndarray:
    """States after each matrix on the best way from ``first`` to ``last``."""
    score = np.full(STATES + 1, -np.inf)
    score[first] = 0.0
    back = np.empty((len(matrices), STATES + 1), np.int64)
    for i, m in enumerate(matrices):
        ways = score[:, None] + m
        back[i] = ways.argmax(axis=0)
        score = ways.max(axis=0)
    path = np.empty(len(matrices), np.int64)
    state = last
    for i in range(len(matrices) - 1, -1, -1):
        path[i] = state
        state = back[i, state]
    return path


def _product(matrices: np.ndarray) -> np.ndarray:
    """Best scores over all of the matrices, one after the other."""
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None, :, :]).max(axis=1)
    return out


def _cells(rows) -> np.ndarray:
    return np.array([np.asarray(r, float) for r in rows]).reshape(-1, STATES + 1, STATES + 1)


def _logs(counts: np.ndarray) -> np.ndarray:
    """Log shares along the last axis, each count one up."""
    up = counts + 1.0
    return np.log(up / up.sum(axis=-1, keepdims=True))


def train(lines: DataFrame) -> Model:
    """Count states and steps of labelled lines: ``conv``, ``turn``, ``at`` in it, ``role``, ``line``.

    Turns of a transcript are numbered without gaps. The counts, some hundred numbers, are all
    that reaches the driver.
    """
    role = F.array_position(F.lit(list(ROLES)), F.col("role")) - 1
    known = lines.select(
        "conv", "turn", "at", role.cast("int").alias("role"),
        code(F.coalesce("line", F.lit(""))).alias("code"),
    ).where("role >= 0")
    state = 2 * F.col("role") + (F.col("at") > 0).cast("int")
    seen = np.zeros((STATES, CODES))
    for s, c, n in known.groupBy(state.alias("state"), "code").count().collect():
        seen[s, c] = n
    step = np.zeros((STATES + 1, STATES))
    turns = known.groupBy("conv", "turn", "role").agg(F.count("*").alias("size"))
    after = turns.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    before = turns.select("conv", (F.col("turn") + 1).alias("turn"), F.lit(1).alias("earlier"))
    inside = turns.groupBy("role").agg(
        F.sum((F.col("size") > 1).cast("long")), F.sum(F.greatest(F.col("size") - 2, F.lit(0)))
    )
    for r, once, more in inside.collect():
        step[2 * r, 2 * r + 1], step[2 * r + 1, 2 * r + 1] = once, more
    ended = 2 * F.col("role") + (F.col("size") > 1).cast("int")
    follows = turns.join(after, ["conv", "turn"]).groupBy(ended.alias("s"), "next").count()
    for s, r, n in follows.collect():
        step[s, 2 * r] = n
    first = turns.join(before, ["conv", "turn"], "left_anti").groupBy("role").count()
    for r, n in first.collect():
        step[START, 2 * r] = n
    logs = _logs(step)
    logs[START, 1::2] = -np.inf  # the first line begins a turn
    for s in range(STATES):  # a turn goes on in its own role
        for r in range(len(ROLES)):
            if s // 2 != r:
                logs[s, 2 * r + 1] = -np.inf
    return Model(logs, _logs(seen))


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` of the turns of raw transcripts.

    ``lines`` has ``conv``, an order ``seq`` and ``line``; ``seq`` may have ties and gaps.
    """
    given = lines.select(
        "conv", "seq", F.coalesce("line", F.lit("")).alias("line"), F.lit(1).cast("long").alias("one")
    ).withColumn("code", code(F.col("line")))
    # Lines numbered from 0 in each transcript, without one task having to hold a transcript.
    numbered = prefix_sums(given, ["conv"], ["seq", "line"], "one", "chat-lines").select(
        "conv", F.col("before").alias("at"), "line", "code"
    )
    block = F.floor(F.col("at") / BLOCK).cast("long").alias("block")

    @F.pandas_udf("array<double>")
    def reduced_codes(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: _product(model.matrices(np.asarray(c))).ravel())

    @F.pandas_udf("array<double>")
    def reduced(matrices: pd.Series) -> pd.Series:
        return matrices.map(lambda m: _product(_cells(m)).ravel())

    @F.pandas_udf("array<int>")
    def states_of_codes(codes: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        rows = zip(codes, first, last, strict=True)
        return pd.Series([_best_path(model.matrices(np.asarray(c)), a, b) for c, a, b in rows])

    @F.pandas_udf("array<int>")
    def states_of_matrices(matrices: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        rows = zip(matrices, first, last, strict=True)
        return pd.Series([_best_path(_cells(m), a, b) for m, a, b in rows])

    def gathered(df: DataFrame, value: str) -> Column:
        """Values of a block, at most ``BLOCK``, in order."""
        return F.transform(
            F.array_sort(F.collect_list(F.struct("at", value))), lambda s: s[value]
        ).alias("values")

    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = []
    now = numbered.groupBy("conv", block).agg(gathered(numbered, "code"))
    now = now.repartition(tasks, "conv", "block")
    now = stage(now.withColumn("m", reduced_codes("values")), "chat-blocks")
    levels.append(now)
    while (now.agg(F.max("block")).first()[0] or 0) > 0:
        up = now.select("conv", F.col("block").alias("at"), "m")
        now = up.groupBy("conv", block).agg(gathered(up, "m"))
        now = stage(now.withColumn("m", reduced("values")), "chat-blocks")
        levels.append(now)
    final = F.slice("m", START * (STATES + 1) + 1, STATES)
    ends = now.select(
        "conv", "block", F.lit(START).alias("first"),
        (F.array_position(final, F.array_max(final)) - 1).cast("int").alias("last"),
    )
    for depth in range(len(levels) - 1, -1, -1):
        path = states_of_codes if depth == 0 else states_of_matrices
        level, e = levels[depth].alias("l"), ends.alias("e")
        same = F.col("l.conv").eqNullSafe(F.col("e.conv")) & (F.col("l.block") == F.col("e.block"))
        met = level.join(e, same).select("l.conv", "l.block", "first", "last", "values")
        # by number: the cost is Python's, so partitions must not be merged by their bytes
        found = met.repartition(tasks, "conv", "block").select(
            "conv", "block", "first", path("values", "first", "last").alias("path")
        )
        # A child starts in the state that the one before it ends in.
        ends = found.select(
            "conv", "block", "first", "path", F.posexplode("path").alias("i", "last")
        ).select(
            "conv",
            (F.col("block") * BLOCK + F.col("i")).alias("block"),
            F.coalesce(F.get("path", F.col("i") - 1), F.col("first")).alias("first"),
            "last",
        )
    placed = ends.select("conv", F.col("block").alias("at"), F.col("last").alias("state"))
    n, p = numbered.alias("n"), placed.alias("p")
    same = F.col("n.conv").eqNullSafe(F.col("p.conv")) & (F.col("n.at") == F.col("p.at"))
    read = stage(
        n.join(p, same).select(
            "n.conv", "n.at", "line", "state", (F.col("state") % 2 == 0).cast("long").alias("begins")
        ),
        "chat-states",
    )
    # Turns so far: of the blocks before, one row per block, and of the lines before in the block.
    starts = read.groupBy("conv", block).agg(F.sum("begins").alias("begun"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select(
        F.col("conv").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy("conv", "block").orderBy("at")
    counted = read.withColumn("block", block).withColumn("turn", F.sum("begins").over(inside))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    said = F.when(F.col("begins") == 1, F.regexp_replace("line", _MARKER, "")).otherwise(F.col("line"))
    return (
        counted.join(offsets, same)
        .select(
            "conv", (F.col("turn") + F.col("offset") - 1).alias("turn"), "at", "state", said.alias("said")
        )
        .groupBy("conv", "turn")
        .agg(
            F.min(F.struct("at", "state"))["state"].alias("state"),
            F.array_sort(F.collect_list(F.struct("at", "said"))).alias("lines"),
        )
        .select(
            "conv", "turn",
            F.get(F.lit(list(ROLES)), F.floor(F.col("state") / 2).cast("int")).alias("role"),
            F.array_join(F.transform("lines", lambda s: s["said"]), "\n").alias("text"),
        )
    )


def rendered(role: Column, text: Column) -> Column:
    """A turn in canonical form: no blank or line break begins or ends its text."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), bare(text), F.lit("\n<|end|>\n"))


def bare(text: Column) -> Column:
    """``text`` without white space around it, such as the break after a marker of its own line."""
    return F.btrim(text, F.lit(" \t\n\r\f\x0b"))


# Ways to write down the three roles; a transcript keeps to one of them.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("SYSTEM: ", "Human: ", "AI: "),
    ("### System:\n", "### Instruction:\n", "### Response:\n"),
    ("[system] ", "[customer] ", "[agent] "),
    ("System: ", "Q: ", "A: "),
)
UNMARKED = 8  # one in so many later turns has no marker


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Labelled lines of conversations as raw transcripts would hold them.

    Each conversation is written in one of the ``STYLES``, by hash, and some turns lack a marker.
    """
    role = F.coalesce(F.array_position(F.lit(list(ROLES)), F.col("role")), F.lit(0)).cast("int")
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(len(STYLES))).cast("int")
    names = F.array(*[F.array(*map(F.lit, s)) for s in STYLES])
    plain = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(UNMARKED)) == 0
    mark = F.when(plain & (F.col("turn") > 0), F.lit("")).otherwise(
        F.coalesce(F.get(F.get(names, style), role - 1), F.lit(""))
    )
    text = F.concat(mark, F.coalesce("text", F.lit("")))
    return conversations.select(
        F.col("conv_id").alias("conv"), "turn", "role", F.posexplode(F.split(text, "\n")).alias("at", "line")
    ).withColumn("seq", F.struct("turn", "at"))
