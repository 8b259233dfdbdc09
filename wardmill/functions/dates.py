"""Date rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardmill.functions.numeric import narrow

# Highest age, and the digits a date can have (the 31st of a short month passes).
MAX_AGE = 150
DATE_DIGITS = r"^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])\z"


def parse_date(c: Column) -> Column:
    """Eight digits ``yyyyMMdd`` to a date, null for anything else.

    Placeholders such as ``00000000`` are ruled out by pattern, as a failing cast is slow.
    """
    text = c.cast("string")
    iso = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(text.rlike(DATE_DIGITS), iso.try_cast("date"))


def completed_years(at: Column, born: Column) -> Column:
    """Calendar years between two dates, less one before the birthday.

    A 29 February birthday has not been reached on 28 February, which
    ``months_between`` gets wrong.
    """
    month_now, month_born = F.month(at), F.month(born)
    early = (month_now < month_born) | (
        (month_now == month_born) & (F.dayofmonth(at) < F.dayofmonth(born))
    )
    return F.year(at) - F.year(born) - F.when(early, 1).otherwise(0)


def age_years(at: Column, born: Column) -> Column:
    """Age in completed years within 0..150; null if a date is missing."""
    years = completed_years(at, born)
    return F.when(years.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(MAX_AGE), years))).cast(
        "smallint"
    )


def stay_days(start: Column, end: Column) -> Column:
    """Days between two dates, 0 if a date is missing; an end before the start is negative."""
    days = narrow(F.date_diff(end, start), "smallint")
    return F.coalesce(days, F.lit(0).cast("smallint"))
