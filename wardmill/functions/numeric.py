"""Number rules as native column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardmill.functions.text import strip_text

# What counts as a number; money text has been cleaned before.
INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
NUMBER = r"^\+?([0-9]+\.?[0-9]*|\.[0-9]+)([eE]\+?[0-9]+)?\z"
SIGNED_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a value; null stays null (``greatest``/``least`` alone would skip it)."""
    bounded = c
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    return F.when(c.isNotNull(), bounded)


# Ranges of the integer types below bigint.
INT_RANGES = {"tinyint": 7, "smallint": 15, "int": 31}


def narrow(c: Column, type_name: str) -> Column:
    """Whole part of a number in a smaller integer type, null out of range.

    The range is tested first: a ``try_cast`` that overflows raises and catches an error inside,
    which is some fifty times slower than the test.
    """
    if type_name not in INT_RANGES:
        return c.try_cast(type_name)
    limit = 1 << INT_RANGES[type_name]
    fits = (c > F.lit(-limit - 1)) & (c < F.lit(limit))
    return F.when(fits, c.cast(type_name))


def whole_number(c: Column) -> Column:
    """Integer text as bigint, null if unreadable or out of range.

    Text that is no number is told apart before the cast, for the reason given in ``narrow``.
    """
    text = c.cast("string")
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def to_int(c: Column, type_name: str) -> Column:
    """Integer text to the given width, null if unreadable or out of range."""
    return narrow(whole_number(c), type_name)


def bounded_int(value: Column, type_name: str, low=None, high=None) -> Column:
    """A bigint in the given width, within bounds; null or out of range gives 0.

    The value is named several times, so it is best a column of an earlier projection.
    """
    value = F.coalesce(narrow(value, type_name), F.lit(0).cast(type_name))
    if low is None and high is None:
        return value
    return clip(value, low, high).cast(type_name)


def coerce_int(c: Column, type_name: str, low=None, high=None) -> Column:
    """Whole number of the given width; unreadable or out of range gives 0."""
    return bounded_int(whole_number(c), type_name, low, high)


def fit(c: Column, source, target) -> Column:
    """Cast between declared types; a value that does not fit becomes null."""
    kind, held = target.simpleString(), source.typeName()
    if held == "string" and kind in (*INT_RANGES, "bigint"):
        return to_int(c, kind)
    if held == "string" and kind in ("float", "double"):
        return to_double(c).cast(target)
    if kind in INT_RANGES and held in ("byte", "short", "integer", "long", "float", "double"):
        return narrow(c, kind)
    return c.try_cast(target)


def to_double(c: Column) -> Column:
    """Number text to double, null if unreadable (a bare cast also takes ``12d``)."""
    return number_value(strip_text(c))


def number_value(text: Column) -> Column:
    """Stripped number text to double, null if unreadable."""
    return F.when(text.rlike(SIGNED_NUMBER), text.try_cast("double"))


def money_text(c: Column) -> Column:
    """Money text with a point as its decimal mark, without blanks and minus signs."""
    return F.translate(c.cast("string"), ", -", ".")


def clean_money(c: Column) -> Column:
    """Money text to a non-negative double.

    The comma is the decimal mark; blanks and minus signs are deleted, so ``-3,2`` is 3.2
    and a text with a thousands point is unreadable and gives 0.
    """
    return money_value(money_text(c))


def money_value(text: Column) -> Column:
    """What ``money_text`` leaves to a non-negative double, 0 if unreadable."""
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def total_of(*parts: Column) -> Column:
    return reduce(add, parts)


def recode(c: Column, mapping: dict) -> Column:
    """Replace single values, leave the others."""
    out = F
    for old, new in mapping.items():
        out = out.when(c == F.lit(old), F.lit(new))
    return out.otherwise(c) if mapping else c


def correct_by(c: Column, condition: Column, value) -> Column:
    """Overwrite a value where another column says it must be different."""
    return F.when(condition, F.lit(value)).otherwise(c)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """Share in percent, null when the whole is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), scale)
