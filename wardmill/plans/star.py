"""Star tables out of the treated and contracted records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.functions import coerce_int, is_blank_code, narrow, strip_text
from wardmill.operators.extract import (
    Satellite,
    extract,
    mode_dimension,
    unpivot_codes,
)
from wardmill.plans.model import CASE, FACT, TABLES
from wardmill.plans.records import INDIGENOUS

# Fact columns in order, hospital attributes, contraceptive columns.
FACT_COLUMNS = (
    "CNES", "N_AIH", "ESPEC", "IDENT", "DT_INTER", "DT_SAIDA", "VAL_SH", "VAL_SP", "VAL_TOT",
    "DIAS_PERM", "COMPLEX", "MUNIC_MOV", "DIAG_PRINC", "NASC", "SEXO", "IDADE", "NACIONAL",
    "NUM_FILHOS", "RACA_COR", "MUNIC_RES", "CEP",
)
HOSPITAL_ATTRIBUTES = ("NATUREZA", "GESTAO", "NAT_JUR")
METHODS = ("CONTRACEP1", "CONTRACEP2")


def _one_per_case(table: str, column: str, where: Column, rule: Column | None = None) -> Satellite:
    """Case id and one column, first row per case."""
    rules = {} if rule is None else {column: rule}
    return Satellite(table, (CASE, column), where, rules, key=(CASE,), dedup="first")


def _intensive_care() -> Satellite:
    names = ("UTI_MES_TO", "UTI_INT_TO")
    rules = {n: narrow(F.col(n), "int") for n in names}
    return Satellite(
        "uti_detalhes",
        tuple(TABLES["uti_detalhes"].schema.names),
        F.col("VAL_UTI") > 0,
        {**rules, "VAL_UTI": F.col("VAL_UTI").cast("double")},
        key=(CASE,),
        dedup="first",
    )


def _code(table: str, column: str, text: Column) -> Satellite:
    return _one_per_case(table, column, ~is_blank_code(F.col(column)), text)


# Extraction specs by table, built on demand because columns need a running session.
SATELLITES: dict[str, Callable[[], Satellite]] = {
    FACT: lambda: Satellite(FACT, FACT_COLUMNS),
    "uti_detalhes": _intensive_care,
    "condicoes_especificas": lambda: _one_per_case(
        "condicoes_especificas", "IND_VDRL", F.col("IND_VDRL") == "1"
    ),
    "obstetricos": lambda: _code("obstetricos", "INSC_PN", strip_text(F.col("INSC_PN"))),
    "instrucao": lambda: _one_per_case(
        "instrucao", "INSTRU", F.col("INSTRU") != 0, narrow(F.col("INSTRU"), "tinyint")
    ),
    "mortes": lambda: _one_per_case("mortes", "CID_MORTE", F.col("MORTE") == "1"),
    "infehosp": lambda: _one_per_case(
        "infehosp", "INFEHOSP", F.col("INFEHOSP") == 1, coerce_int(F.col("INFEHOSP"), "int")
    ),
    "vincprev": lambda: _code("vincprev", "VINCPREV", F.upper(strip_text(F.col("VINCPREV")))),
    "cbor": lambda: _one_per_case("cbor", "CBOR", F.col("CBOR") > 0, narrow(F.col("CBOR"), "int")),
    "etnia": lambda: Satellite(
        "etnia",
        (CASE, "ETNIA"),
        (F.col("RACA_COR") == INDIGENOUS) & (F.col("ETNIA") > 0),
        {"ETNIA": narrow(F.col("ETNIA"), "int")},
        dedup="rows",
    ),
    "notificacoes": lambda: _one_per_case(
        "notificacoes", "CID_NOTIF", F.col("CID_NOTIF") != "0"
    ),
    "pernoite": lambda: Satellite("pernoite", (CASE, "DIAR_ACOM"), F.col("DIAR_ACOM") > 0),
    # A code with a leading zero is a placeholder, whatever follows.
    "diagnosticos": lambda: Satellite(
        "diagnosticos",
        (CASE, "DIAG_SECUN"),
        ~F.col("DIAG_SECUN").startswith("0"),
        dedup="rows",
    ),
}


def contraceptives(contracted: DataFrame) -> DataFrame:
    """One row per case and contraceptive column with a method in it."""
    return unpivot_codes(contracted, [CASE], METHODS, "TIPO", "CODIGO_METODO")


def hospitals(contracted: DataFrame) -> DataFrame:
    """One row per hospital with the most frequent value of each attribute.

    Sorted within files, which is what readers by hospital profit from.
    """
    return mode_dimension(contracted, "CNES", HOSPITAL_ATTRIBUTES).sortWithinPartitions("CNES")


def services(treated: DataFrame) -> DataFrame:
    """Every billed procedure, repeats kept; read before contraction."""
    return treated.select(CASE, "PROC_REA")


def star_table(name: str, treated: DataFrame, contracted: DataFrame) -> DataFrame:
    """One table made from the records. ``contracted`` is unique on the case id."""
    if name == "contraceptivos":
        return contraceptives(contracted)
    if name == "hospital":
        return hospitals(contracted)
    if name == "atendimentos":
        return services(treated)
    return extract(contracted, SATELLITES[name](), unique_on=(CASE,))


# The tables made from the records, in the order they are made.
STAR = (
    "internacoes", "uti_detalhes", "condicoes_especificas", "hospital", "obstetricos",
    "instrucao", "mortes", "infehosp", "vincprev", "cbor", "contraceptivos", "etnia",
    "notificacoes", "pernoite", "diagnosticos", "atendimentos",
)


def star_tables(treated: DataFrame, contracted: DataFrame) -> dict[str, DataFrame]:
    """The 16 tables made from the records."""
    return {name: star_table(name, treated, contracted) for name in STAR}
