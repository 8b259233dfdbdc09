"""Cleaning and contraction of admission records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions import (
    age_years,
    bounded_int,
    clip,
    code_value,
    correct_by,
    money_text,
    money_value,
    narrow,
    number_value,
    parse_date,
    recode,
    region_digits,
    region_value,
    stay_days,
    strip_text,
    total_of,
    upper_text,
    whole_number,
)
from wardmill.operators.contract import contract
from wardmill.operators.project import apply_rules, ensure_columns
from wardmill.operators.standing import Contraction
from wardmill.session import settle

# The 46 columns of a record, in order.
COLUMNS = (
    "ESPEC", "N_AIH", "IDENT", "CEP", "MUNIC_RES", "NASC", "SEXO", "DT_INTER", "DT_SAIDA",
    "UTI_MES_TO", "MARCA_UTI", "UTI_INT_TO", "DIAR_ACOM", "PROC_REA", "VAL_SH", "VAL_SP",
    "VAL_TOT", "VAL_UTI", "NATUREZA", "CNES", "NAT_JUR", "GESTAO", "IND_VDRL", "IDADE",
    "DIAG_PRINC", "DIAG_SECUN", "MORTE", "MUNIC_MOV", "DIAS_PERM", "NACIONAL", "NUM_FILHOS",
    "INSTRU", "CID_NOTIF", "CONTRACEP1", "CONTRACEP2", "GESTRICO", "INSC_PN", "CBOR", "CNAER",
    "VINCPREV", "INFEHOSP", "CID_ASSO", "CID_MORTE", "COMPLEX", "RACA_COR", "ETNIA",
)

# Integer columns by width, and the other column groups.
INTEGERS = {
    "bigint": ("N_AIH", "CNES", "CEP", "PROC_REA"),
    "int": ("DIAR_ACOM", "UTI_MES_TO", "UTI_INT_TO", "NAT_JUR", "CBOR"),
    "smallint": ("IDADE", "DIAS_PERM", "NACIONAL", "GESTAO", "NATUREZA"),
    "tinyint": ("SEXO", "NUM_FILHOS", "RACA_COR", "INSTRU", "COMPLEX"),
}
MONEY = ("VAL_SH", "VAL_SP", "VAL_TOT", "VAL_UTI")
COMPONENTS = ("VAL_SH", "VAL_SP", "VAL_UTI")
DATES = ("DT_INTER", "DT_SAIDA", "NASC")
REGIONS = ("MUNIC_RES", "MUNIC_MOV")
CODES = ("DIAG_PRINC", "DIAG_SECUN", "CID_NOTIF", "CID_ASSO", "CID_MORTE")
MEANS = ("UTI_MES_TO", "UTI_INT_TO", "DIAR_ACOM")
# Limits and corrections.
NATIONALITY_DEFAULT = {0: 10}
NATIONALITY_MAX = 350
RACE_MAX = 99
ETHNICITY_MAX = 264
INDIGENOUS = 5


def _reading(columns: list[str]) -> dict[str, Column]:
    """Numbers and trimmed texts of raw columns.

    The rules on them name a value up to a dozen times; as columns of an earlier projection
    each is worked out once.
    """
    rules = {n: whole_number(F.col(n)) for names in INTEGERS.values() for n in names}
    rules["ETNIA"] = whole_number(F.col("ETNIA"))
    rules.update({n: money_text(F.col(n)) for n in MONEY})
    rules.update({n: region_digits(F.col(n)) for n in REGIONS})
    rules.update({n: upper_text(F.col(n)) for n in CODES})
    return {n: rule for n, rule in rules.items() if n in columns}


def _first_pass(columns: list[str]) -> dict[str, Column]:
    """Rules that read one column of ``_reading``, or a raw date, each."""
    rules: dict[str, Column] = {}
    for type_name, names in INTEGERS.items():
        rules.update({n: bounded_int(F.col(n), type_name) for n in names})
    rules.update({n: money_value(F.col(n)) for n in MONEY})
    rules.update({n: parse_date(F.col(n)) for n in DATES})
    rules.update({n: region_value(F.col(n)) for n in REGIONS})
    rules.update({n: code_value(F.col(n)) for n in CODES})
    rules["PROC_REA"] = bounded_int(F.col("PROC_REA"), "bigint", low=0)
    rules["NACIONAL"] = clip(
        recode(bounded_int(F.col("NACIONAL"), "smallint"), NATIONALITY_DEFAULT), 0, NATIONALITY_MAX
    ).cast("smallint")
    if {"RACA_COR", "ETNIA"} <= set(columns):
        rules["RACA_COR"] = bounded_int(F.col("RACA_COR"), "tinyint", 0, RACE_MAX)
        # Wide enough for every code up to the limit.
        rules["ETNIA"] = bounded_int(F.col("ETNIA"), "smallint", 0, ETHNICITY_MAX)
    elif "ETNIA" in columns:
        rules["ETNIA"] = bounded_int(F.col("ETNIA"), "smallint")
    return {n: rule for n, rule in rules.items() if n in columns}


def derived(columns: list[str]) -> Mapping[str, Column]:
    """Total, stay and age from the cleaned columns that are present."""
    present = set(columns)
    out: dict[str, Column] = {}
    if set(COMPONENTS) <= present:
        out["VAL_TOT"] = total_of(*[F.col(c) for c in COMPONENTS])
    if {"DT_INTER", "DT_SAIDA"} <= present:
        out["DIAS_PERM"] = stay_days(F.col("DT_INTER"), F.col("DT_SAIDA"))
    if {"DT_INTER", "NASC"} <= present:
        out["IDADE"] = age_years(F.col("DT_INTER"), F.col("NASC"))
    return out


def treat(raw: DataFrame) -> DataFrame:
    """Clean and type raw text records. Every row is kept, one projection per pass: read, rules of
    one column, rules of several.

    A rule applies only if its column exists. An id that cannot be read becomes 0; see
    ``unidentified``.
    """
    frame = ensure_columns(raw, {"VAL_UTI": F.lit("0")})
    settle(raw.sparkSession)
    read = apply_rules(frame, _reading(frame.columns))
    cleaned = apply_rules(read, _first_pass(frame.columns))
    second = dict(derived(cleaned.columns))
    if {"RACA_COR", "ETNIA"} <= set(cleaned.columns):
        foreign = (F.col("RACA_COR") != INDIGENOUS) & (F.col("ETNIA") != 0)
        second["RACA_COR"] = correct_by(F.col("RACA_COR"), foreign, INDIGENOUS).cast("tinyint")
    absent = {c: F.lit(None) for c in second if c not in cleaned.columns}
    return apply_rules(ensure_columns(cleaned, absent), second)


def type_only(raw: DataFrame) -> DataFrame:
    """Types without imputation: money, dates and three small integers; failures are null."""
    frame = ensure_columns(raw, {"VAL_UTI": F.lit("0")})
    widths = {"NACIONAL": "smallint", "NUM_FILHOS": "tinyint", "ETNIA": "tinyint"}
    settle(raw.sparkSession)
    reading = {n: strip_text(F.col(n)) for n in MONEY} | {n: whole_number(F.col(n)) for n in widths}
    rules = {n: number_value(F.col(n)) for n in MONEY}
    rules.update({n: parse_date(F.col(n)) for n in DATES})
    rules.update({n: narrow(F.col(n), type_name) for n, type_name in widths.items()})
    return apply_rules(apply_rules(frame, reading), rules)


def unidentified(raw: DataFrame) -> DataFrame:
    """Raw rows whose case id cannot be read; ``treat`` files them under id 0."""
    return raw.where(whole_number(F.col("N_AIH")).isNull())


def first_by() -> list[str | Column]:
    """Known admission date first, then known discharge, then procedure; other columns follow."""
    unknown = [F.col(c).isNull() for c in ("DT_INTER", "DT_SAIDA")]
    return [unknown[0], "DT_INTER", unknown[1], "DT_SAIDA", "PROC_REA"]


def contract_records(treated: DataFrame) -> DataFrame:
    """One row per case id.

    Money is summed, bed days are averaged, everything else comes from the earliest row.
    """
    return contract(
        treated,
        key=("N_AIH",),
        sums=[c for c in COMPONENTS if c in treated.columns],
        means=[c for c in MEANS if c in treated.columns],
        order=first_by(),
        recomputed=derived(treated.columns),
    )


def record_contraction(columns: Sequence[str] = COLUMNS) -> Contraction:
    """The same contraction, for states that are kept between loads."""
    return Contraction(
        columns=tuple(columns),
        key=("N_AIH",),
        sums=[c for c in COMPONENTS if c in columns],
        means=[c for c in MEANS if c in columns],
        order=first_by(),
        recomputed=derived,
    )
