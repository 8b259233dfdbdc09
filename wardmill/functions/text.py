"""Text rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ASCII_SPACE = "\t\n\x0b\x0c\r "
# The federal district's prefix and its single code, the unknown code.
DISTRICT_PREFIX = "53"
DISTRICT_CODE = "530010"
UNKNOWN_REGION = "000000"
REGION_WIDTH = 6
MISSING_CODE = "0"


def strip_text(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` alone leaves tabs)."""
    text = c.cast("string")
    # Each character at an end is looked up in the list; the short one is enough for plain text.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_SPACE))).otherwise(
        F.btrim(text, F.lit(WHITE_SPACE))
    )


def is_blank_code(c: Column) -> Column:
    """True for null, the empty string and any run of zeros."""
    return F.coalesce(F.btrim(c, F.lit("0")), F.lit("")) == ""


def code_text(c: Column) -> Column:
    """Trimmed upper-case code; a blank one becomes ``"0"``."""
    return code_value(upper_text(c))


def upper_text(c: Column) -> Column:
    return F.upper(strip_text(c))


def code_value(code: Column) -> Column:
    """A trimmed code; a blank one becomes ``"0"``."""
    return F.when(is_blank_code(code), F.lit(MISSING_CODE)).otherwise(code)


def region_code(c: Column) -> Column:
    """Six-digit region code as bigint, 0 when unknown or unreadable."""
    return region_value(region_digits(c))


def region_digits(c: Column) -> Column:
    """The six digits of a region code, the empty string when unreadable."""
    text = F.coalesce(strip_text(c), F.lit(UNKNOWN_REGION))
    text = F.when(text.startswith(DISTRICT_PREFIX), F.lit(DISTRICT_CODE)).otherwise(text)
    padded = F.lpad(F.substring(text, 1, REGION_WIDTH), REGION_WIDTH, "0")
    # Anything but digits, a negative code included, ends as 0. Extracting instead of testing
    # and casting evaluates the chain above once.
    return F.regexp_extract(padded, r"^\+?([0-9]+)\z", 1)


def region_value(digits: Column) -> Column:
    """Digits of a region code as bigint, 0 when there are none."""
    return F.when(digits != "", digits.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))
