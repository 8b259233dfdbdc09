from wardmill.functions.dates import age_years, parse_date, stay_days
from wardmill.functions.numeric import (
    bounded_int,
    clean_money,
    clip,
    coerce_int,
    correct_by,
    fit,
    money_text,
    money_value,
    narrow,
    number_value,
    percent,
    recode,
    to_double,
    to_int,
    total_of,
    whole_number,
)
from wardmill.functions.text import (
    code_text,
    code_value,
    is_blank_code,
    region_code,
    region_digits,
    region_value,
    strip_text,
    upper_text,
)

__all__ = [
    "age_years",
    "bounded_int",
    "clean_money",
    "clip",
    "code_text",
    "code_value",
    "coerce_int",
    "correct_by",
    "fit",
    "is_blank_code",
    "money_text",
    "money_value",
    "narrow",
    "number_value",
    "parse_date",
    "percent",
    "recode",
    "region_code",
    "region_digits",
    "region_value",
    "stay_days",
    "strip_text",
    "to_double",
    "to_int",
    "total_of",
    "upper_text",
    "whole_number",
]
