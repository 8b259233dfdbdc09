"""Declarative checks: each is a frame of violating rows; a scorecard counts them.

All row-level checks of one table are counted in a single aggregation over it. Unique and
relationship checks of all tables share two: one of keys that are whole numbers, kept as bits, and
one of other keys, kept as text. Distinct-per-key checks aggregate by key first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from wardmill.operators.keys import orphan_counts
from wardmill.session import stage

WORD = 64  # bits of a long
ROLES = "array<struct<g:int,is_child:boolean>>"
SCORE_COLUMNS = ("check_name", "table_name", "column_name", "violations", "passed", "reason")


@dataclass(frozen=True)
class RowCheck:
    """A row violates the check where ``violates`` is true; null counts as a pass."""

    name: str
    table: str
    column: str
    violates: Column


@dataclass(frozen=True)
class UniqueCheck:
    """Key values held by more than one row; keys with a null member are ignored."""

    table: str
    columns: tuple[str, ...]
    name: str = "unique"


@dataclass(frozen=True)
class RelationshipCheck:
    """Child rows whose non-null key has no parent."""

    table: str
    columns: tuple[str, ...]
    to_table: str
    to_columns: tuple[str, ...]
    name: str = "relationships"


@dataclass(frozen=True)
class DistinctPerKeyCheck:
    """Keys tied to more than ``limit`` distinct values of ``column``."""

    table: str
    key: str
    column: str
    limit: int
    name: str = "distinct_per_key"


Check = RowCheck | UniqueCheck | RelationshipCheck | DistinctPerKeyCheck


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck("not_null", table, column, F.col(column).isNull())


def accepted_values(table: str, column: str, values: Sequence) -> RowCheck:
    """Compared in the column's own type, so integer codes need integer values."""
    return RowCheck("accepted_values", table, column, ~F.col(column).isin(*values))


def matches(table: str, column: str, pattern: str) -> RowCheck:
    return RowCheck("format", table, column, ~F.col(column).rlike(pattern))


def within(table: str, column: str, above, up_to) -> RowCheck:
    c = F.col(column)
    return RowCheck("range", table, column, (c <= F.lit(above)) | (c > F.lit(up_to)))


def non_negative(table: str, columns: Sequence[str]) -> RowCheck:
    bad = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])
    return RowCheck("non_negative", table, "+".join(columns), bad)


def in_order(table: str, first: str, second: str) -> RowCheck:
    return RowCheck("date_order", table, f"{first}..{second}", F.col(second) < F.col(first))


def recomputed(
    table: str, column: str, expected: Column, applies: Column | None = None
) -> RowCheck:
    """Stored value differs from the recomputed one."""
    differs = F.col(column) != expected
    return RowCheck("recompute", table, column, differs if applies is None else applies & differs)


def duplicated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values on more than one row, with their row count."""
    keys = df.select(*columns).dropna(how="any")
    return keys.groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def keys_with_many(df: DataFrame, key: str, column: str, limit: int) -> DataFrame:
    """Keys tied to more than ``limit`` distinct values.

    Pairs are made distinct first, so a key on a third of the rows is spread over its values.
    """
    return (
        df.groupBy(key)
        .agg(F.countDistinct(column).alias("distinct_values"))
        .where(F.col("distinct_values") > limit)
    )


def violations(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows or keys that break one check; an empty frame is a pass."""
    df = tables[check.table]
    if isinstance(check, RowCheck):
        return df.where(check.violates)
    if isinstance(check, UniqueCheck):
        return duplicated_keys(df, check.columns)
    if isinstance(check, RelationshipCheck):
        return orphan_counts(df, check.columns, tables[check.to_table], check.to_columns)
    return keys_with_many(df, check.key, check.column, check.limit)


def _score_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counts = df.agg(
        *[F.count_if(check.violates).alias(f"c{i}") for i, check in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.table).alias("table_name"),
                F.lit(check.column).alias("column_name"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, check in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def _score_many(tables: Mapping[str, DataFrame], check: DistinctPerKeyCheck) -> DataFrame:
    counted = violations(tables, check).agg(F.count("*").alias("violations"))
    return counted.select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(column_of(check)).alias("column_name"),
        "violations",
    )


def _key_types(tables: Mapping[str, DataFrame], check: Check) -> list[DataType]:
    """The types in which the members of a key compare, as a join of both sides would have them.

    A member that is text on one side only is compared as text.
    """
    child = tables[check.table].select(*check.columns)
    ours = [f.dataType for f in child.schema.fields]
    if not isinstance(check, RelationshipCheck):
        return ours
    parent = tables[check.to_table].select(*check.to_columns)
    types = []
    for i, own in enumerate(ours):
        text = [isinstance(t, StringType) for t in (own, parent.schema.fields[i].dataType)]
        if any(text):
            types.append(StringType())
        else:
            both = [side.select(F.col(side.columns[i]).alias("k")) for side in (child, parent)]
            types.append(both[0].union(both[1]).schema.fields[0].dataType)
    return types


def _counts_up(types: Sequence[DataType]) -> bool:
    """Whether a key is one whole number that fits a long."""
    if len(types) != 1:
        return False
    kind = types[0]
    small = isinstance(kind, DecimalType) and kind.scale == 0 and kind.precision <= 18
    return small or isinstance(kind, (ByteType, ShortType, IntegerType, LongType))


def _key_text(columns: Sequence[str], types: Sequence[DataType]) -> Column:
    """A key as text, null if a member is; equal keys read the same in their common type."""
    parts = []
    for name, kind in zip(columns, types, strict=True):
        value = F.col(name).cast(kind)
        if isinstance(kind, (FloatType, DoubleType)):
            value += F.lit(0.0)  # zero has one sign
        parts.append(value.cast("string"))
    whole = parts[0] if len(parts) == 1 else F.to_json(F.struct(*parts))
    return F.when(reduce(lambda a, b: a & b, [p.isNotNull() for p in parts]), whole)


def _text_use(columns, types, number: int, child: int) -> Column:
    return F.struct(
        F.lit(number).alias("g"), _key_text(columns, types).alias("k"),
        F.lit(child).cast("long").alias("child"), F.lit(1 - child).alias("parent"),
    )


def _number_use(columns, types, number: int, child: int) -> Column:
    """A whole number as one bit of a word of 64."""
    key = F.col(columns[0]).cast("long")
    place = F.pmod(key, F.lit(WORD)).cast("int")
    bit, none = F.call_function("shiftleft", F.lit(1).cast("long"), place), F.lit(0).cast("long")
    return F.struct(
        F.lit(number).alias("g"), F.shiftright(key, 6).alias("word"),
        (bit if child else none).alias("ours"), (none if child else bit).alias("theirs"),
        F.lit(child).cast("long").alias("child"),
    )


def _count_texts(keys: DataFrame) -> DataFrame:
    """``g``, repeated keys and child rows without a parent; keys are counted in one exchange."""
    return (
        keys.where("k IS NOT NULL")
        .groupBy("g", "k")
        .agg(F.sum("child").alias("n"), F.max("parent").alias("known"))
        .groupBy("g")
        .agg(
            F.count_if(F.col("n") > 1).alias("repeated"),
            F.sum(F.when(F.col("known") == 0, F.col("n")).otherwise(0)).alias("orphans"),
        )
    )


def _read_numbers(tables: Mapping[str, DataFrame], wanted: Sequence[tuple[int, tuple]]) -> DataFrame:
    """The whole numbers of the wanted columns under their numbers, each table being read once."""
    uses: dict[str, list[Column]] = {}
    for number, (name, columns) in wanted:
        uses.setdefault(name, []).append(_number_use(columns, [LongType()], number, 1))
    parts = [tables[name].select(F.inline(F.array(*found))) for name, found in uses.items()]
    return reduce(DataFrame.unionByName, parts)


def _handed_out(words: DataFrame, groups: Mapping[int, Sequence[int]]) -> DataFrame:
    """The words of columns for the groups that name them: a child, and its parent if there is one."""
    listed = [[] for _ in range(1 + max(column for group in groups.values() for column in group))]
    for number, group in groups.items():
        for i, column in enumerate(group):
            listed[column].append(F.struct(F.lit(number).alias("g"), F.lit(i == 0).alias("is_child")))
    roles = F.array(*[F.array(*found).cast(ROLES) for found in listed])
    mine, none = F.col("is_child"), F.lit(0).cast("long")
    handed = words.select(F.inline(F.get(roles, F.col("g"))), F.col("ours").alias("bits"), "word", "n")
    return handed.groupBy("g", "word").agg(
        F.bit_or(F.when(mine, F.col("bits")).otherwise(none)).alias("ours"),
        F.bit_or(F.when(mine, none).otherwise(F.col("bits"))).alias("theirs"),
        F.sum(F.when(mine, F.col("n")).otherwise(none)).alias("n"),
    )


def _count_numbers(
    keys: DataFrame,
    refers: Sequence[int],
    groups: Mapping[int, Sequence[int]] | None = None,
    read_again: Callable[[Sequence[int]], DataFrame] | None = None,
) -> list[DataFrame]:
    """As ``_count_texts``, for whole numbers kept as bits.

    What is exchanged is one row for each word of 64 neighbouring keys, with the bits that occur
    as a child and as a parent and the number of child rows, combined on the map side; a lone key
    costs no more than it would by itself. A word without a fault, as all are in clean data,
    adds nothing and ends there. Where all children of a word lack a parent, its rows are the
    orphans. Only keys in the other faulty words are read a second time and counted one by one.

    With ``groups`` the keys are those of columns, each read and counted once, and their words are
    handed to the groups that name the column; ``read_again`` reads the children of some groups.
    """
    keys = keys.where("word IS NOT NULL")
    refer = F.col("g").isin(*refers) if refers else F.lit(False)
    lacking = F.col("ours").bitwiseAND(F.bitwise_not("theirs"))
    words = keys.groupBy("g", "word").agg(
        F.bit_or("ours").alias("ours"), F.bit_or("theirs").alias("theirs"), F.sum("child").alias("n")
    )
    words = words if groups is None else _handed_out(words, groups)
    faulty = words.where(F.when(refer, lacking != 0).otherwise(F.col("n") > F.bit_count("ours")))
    faulty = stage(faulty, "key-words")
    alone = refer & (F.col("ours").bitwiseAND(F.col("theirs")) == 0)
    found = [
        faulty.where(alone).groupBy("g").agg(
            F.lit(0).cast("long").alias("repeated"), F.sum("n").alias("orphans")
        )
    ]
    mixed = faulty.where(~alone).select("g", "word", F.col("theirs").alias("known"))
    again = sorted(row["g"] for row in mixed.select("g").distinct().collect())  # groups, so few
    if again:
        single = (
            (read_again(again) if read_again else keys)
            .where("child = 1")
            .select("g", "word", "ours")
            .join(mixed, ["g", "word"])
            .where(F.col("ours").bitwiseAND(F.bitwise_not("known")) != 0)
            .groupBy("g", "word", "ours")
            .agg(F.count("*").alias("n"))
        )
        found.append(
            single.groupBy("g").agg(
                F.count_if(F.col("n") > 1).alias("repeated"), F.sum("n").alias("orphans")
            )
        )
    return found


def _score_keys(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All unique and relationship checks by one aggregation of numbers and one of other keys.

    Checks of one key share a group. Every table gives its whole-number columns once, whatever
    groups they are in, and its other keys for each group as a child or as a parent.
    """
    groups: dict[tuple, int] = {}
    columns: dict[tuple, int] = {}
    numbers: dict[int, list[int]] = {}
    texts: dict[str, list[Column]] = {}
    listed = []
    for check in checks:
        to = (check.to_table, check.to_columns) if isinstance(check, RelationshipCheck) else ()
        group = (check.table, check.columns, *to)
        if group not in groups:
            number = groups[group] = len(groups)
            types = _key_types(tables, check)
            sides = [(check.table, check.columns), *([to] if to else [])]
            if _counts_up(types):
                numbers[number] = [columns.setdefault(side, len(columns)) for side in sides]
            else:
                for i, (name, members) in enumerate(sides):
                    use = _text_use(members, types, number, 1 - i)
                    texts.setdefault(name, []).append(use)
        listed.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.table).alias("table_name"),
                F.lit(column_of(check)).alias("column_name"),
                F.lit(groups[group]).alias("g"),
                F.lit(bool(to)).alias("refers"),
            )
        )

    counts = []
    if numbers:
        held = list(columns)
        refers = [number for number, group in numbers.items() if len(group) == 2]
        keys = _read_numbers(tables, [(i, column) for i, column in enumerate(held)])

        def read_again(wanted: Sequence[int]) -> DataFrame:
            return _read_numbers(tables, [(number, held[numbers[number][0]]) for number in wanted])

        counts += _count_numbers(keys, refers, numbers, read_again)
    if texts:
        parts = [tables[t].select(F.inline(F.array(*found))) for t, found in texts.items()]
        counts.append(_count_texts(reduce(DataFrame.unionByName, parts)))
    counted = (
        reduce(DataFrame.unionByName, counts)
        .groupBy("g")
        .agg(F.sum("repeated").alias("repeated"), F.sum("orphans").alias("orphans"))
    )
    named = counted.sparkSession.range(1).select(F.inline(F.array(*listed)))
    found = F.when(F.col("refers"), F.col("orphans")).otherwise(F.col("repeated"))
    return named.join(counted, "g", "left").select(
        "check_name", "table_name", "column_name",
        F.coalesce(found, F.lit(0)).cast("long").alias("violations"),
    )


def absent_tables(tables: Mapping[str, DataFrame], check: Check) -> list[str]:
    """Tables that a check needs and that are not there."""
    needed = [check.table, check.to_table] if isinstance(check, RelationshipCheck) else [check.table]
    return [name for name in dict.fromkeys(needed) if name not in tables]


def column_of(check: Check) -> str:
    if isinstance(check, (RowCheck, DistinctPerKeyCheck)):
        return check.column
    return "+".join(check.columns)


def scorecard(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: violations and whether it passed.

    A check that needs an absent table has null violations, has not passed, and gives the reason.
    """
    by_table: dict[str, list[RowCheck]] = {}
    keyed: list[Check] = []
    many: list[DistinctPerKeyCheck] = []
    absent: list[tuple] = []
    for check in checks:
        missing = absent_tables(tables, check)
        if missing:
            reason = f"no table {', '.join(missing)}"
            absent.append((check.name, check.table, column_of(check), None, False, reason))
        elif isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        elif isinstance(check, DistinctPerKeyCheck):
            many.append(check)
        else:
            keyed.append(check)
    parts = [_score_rows(tables[name], group) for name, group in by_table.items()]
    parts += [_score_keys(tables, keyed)] if keyed else []
    parts += [_score_many(tables, check) for check in many]
    found = []
    if parts:
        scored = reduce(DataFrame.unionByName, parts)
        passed = (F.col("violations") == 0).alias("passed")
        found.append(scored.select("*", passed, F.lit(None).cast("string").alias("reason")))
    if absent or not parts:
        spark = next(iter(tables.values())).sparkSession
        schema = "check_name string, table_name string, column_name string, violations long, "
        found.append(spark.createDataFrame(absent, schema + "passed boolean, reason string"))
    return reduce(DataFrame.unionByName, found)
