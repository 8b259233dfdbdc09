"""One row per key: sums, means and the first row's other values in a single aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIRST = "_first"
# Bits of the whole numbers that can share a long, one value being left for null.
BITS = {"boolean": 2, "byte": 9, "short": 17, "integer": 33, "date": 33}
LONG_BITS = 63
# A text ends with END, so no text may hold it; ESCAPE begins what stands for either.
END, ESCAPE = "\x00", "\x01"
ESCAPED = ((ESCAPE, "\x01\x02"), (END, "\x01\x01"))


def _lowest(kind: str) -> int:
    return 0 if kind == "boolean" else -(1 << (BITS[kind] - 2))


def _as_bits(c: Column, kind: str) -> Column:
    """A whole number counted from 1, null being 0."""
    value = F.unix_date(c) if kind == "date" else c.cast("int") if kind == "boolean" else c
    return F.coalesce(value.cast("long") + F.lit(1 - _lowest(kind)), F.lit(0).cast("long"))


def _from_bits(packed: Column, shift: int, kind: str, type_: T.DataType) -> Column:
    number = F.shiftright(packed, shift).bitwiseAND(F.lit((1 << BITS[kind]) - 1))
    value = F.when(number > 0, number + F.lit(_lowest(kind) - 1))
    return F.date_from_unix_date(value.cast("int")) if kind == "date" else value.cast(type_)


def _as_text(c: Column) -> Column:
    """A text that ends with ``END``, marked to be more than a null; sorts as the text does."""
    for plain, written in ESCAPED:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return F.coalesce(F.concat(F.lit(ESCAPE), c, F.lit(END)), F.lit(END))


def _from_text(packed: Column, place: int) -> Column:
    part = F.split_part(packed, F.lit(END), F.lit(place + 1))
    text = F.substring(part, F.lit(2), F.length(part))
    for plain, written in reversed(ESCAPED):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return F.when(part != "", text)


def _runs(fields: Sequence[tuple[str, Column, T.DataType]]) -> list[list[tuple]]:
    """Neighbouring fields that can share one: small whole numbers, or texts."""
    runs: list[list[tuple]] = []
    room, last = 0, ""
    for name, column, type_ in fields:
        kind = type_.typeName()
        bits = BITS.get(kind, 0)
        what = "bits" if bits else "text" if type_ == T.StringType() else ""
        if runs and what and what == last and bits <= room:
            runs[-1].append((name, column, type_))
        else:
            runs.append([(name, column, type_)])
            room = LONG_BITS
        room, last = room - bits, what
    return runs


def _in_order(
    order: Sequence[str | Column], columns: Sequence[str]
) -> list[tuple[str, Column]]:
    """The fields that sort by ``order``, then by the other carried columns, so ties cannot arise.

    A carried column named in ``order`` is moved to the front; only expressions and columns
    that are not carried take room of their own.
    """
    lead, rest = [], list(columns)
    for i, item in enumerate(order):
        if isinstance(item, str) and item in rest:
            lead.append((item, F.col(item)))
            rest.remove(item)
        else:
            lead.append((f"_o{i}", F.col(item) if isinstance(item, str) else item))
    return [*lead, *[(c, F.col(c)) for c in rest]]


def _ordered_row(order: Sequence[str | Column], columns: Sequence[str]) -> Column:
    """Struct of the fields of ``_in_order`` under their names, as it is stored between loads."""
    return F.struct(*[c.alias(name) for name, c in _in_order(order, columns)])


def _packed_row(
    df: DataFrame, order: Sequence[str | Column], columns: Sequence[str]
) -> tuple[Column, dict[str, Column]]:
    """Struct that sorts as that of ``_ordered_row``, and the carried columns read back from it.

    A field costs eight bytes or more in every row that is sorted and shuffled, so neighbours
    share one: small whole numbers a long, texts a text.
    """
    named = _in_order(order, columns)
    types = [f.dataType for f in df.select(*[c.alias(n) for n, c in named]).schema.fields]
    fields, back = [], {}
    runs = _runs([(*item, type_) for item, type_ in zip(named, types, strict=True)])
    for i, run in enumerate(runs):
        held = F.col(f"{_FIRST}._f{i}")
        if len(run) == 1:
            name, field, _ = run[0]
            back[name] = held
        elif run[0][2] == T.StringType():
            field = F.concat(*[_as_text(column) for _, column, _ in run])
            back |= {name: _from_text(held, place) for place, (name, _, _) in enumerate(run)}
        else:
            field, shift = F.lit(0).cast("long"), 0
            for _, column, type_ in run:
                kind = type_.typeName()
                field = F.shiftleft(field, BITS[kind]).bitwiseOR(_as_bits(column, kind))
            for name, _, type_ in reversed(run):
                kind = type_.typeName()
                back[name] = _from_bits(held, shift, kind, type_)
                shift += BITS[kind]
        fields.append(field.alias(f"_f{i}"))
    return F.struct(*fields), {c: back[c] for c in columns}


def contract(
    df: DataFrame,
    key: Sequence[str],
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    order: Sequence[str | Column] = (),
    recomputed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Collapse ``df`` to one row per key.

    ``sums`` and ``means`` name the aggregated columns, ``recomputed`` holds expressions over
    the contracted row; every other column comes whole from the first row under ``order``,
    nulls included. The minimum over a struct is combined on the map side, so a key that holds
    much of the table reaches its reducer as one row per map task. Order by column names where
    possible, expressions are shuffled beside the row.
    """
    recomputed = dict(recomputed or {})
    plain = {*key, *sums, *means, *recomputed}
    carried = [c for c in df.columns if c not in plain]
    aggregates = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    aggregates += [F.avg(c).alias(c) for c in means]
    first: dict[str, Column] = {}
    if carried:
        row, first = _packed_row(df, order, carried)
        aggregates.append(F.min(row).alias(_FIRST))
    grouped = df.groupBy(*key).agg(*aggregates) if aggregates else df.select(*key).distinct()
    flat = grouped.select(*key, *sums, *means, *[c.alias(name) for name, c in first.items()])
    names = list(df.columns) + [c for c in recomputed if c not in df.columns]
    return flat.select(*[recomputed[c].alias(c) if c in recomputed else F.col(c) for c in names])


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """The first row per key under ``order``."""
    return contract(df, key, order=order)
