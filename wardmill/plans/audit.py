"""The declared checks on the star tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.functions.dates import completed_years
from wardmill.operators.quality import (
    Check,
    DistinctPerKeyCheck,
    RelationshipCheck,
    RowCheck,
    UniqueCheck,
    accepted_values,
    in_order,
    matches,
    non_negative,
    not_null,
    recomputed,
    scorecard,
    within,
)
from wardmill.plans.model import FACT, TABLES

# Columns that must not be null.
NOT_NULL = {
    "internacoes": (
        "N_AIH", "CNES", "DIAG_PRINC", "MUNIC_RES", "DT_INTER", "DT_SAIDA", "DIAS_PERM", "IDADE",
        "SEXO", "RACA_COR", "VAL_TOT", "VAL_SH", "VAL_SP",
    ),
    "hospital": ("CNES", "NATUREZA"),
    "instrucao": ("INSTRU",),
    "procedimentos": ("PROC_REA",),
    "etnia": ("N_AIH", "ETNIA"),
    "atendimentos": ("PROC_REA", "N_AIH"),
    "mortes": ("N_AIH",),
    "diagnosticos": ("DIAG_SECUN",),
    "cid10": ("CID",),
    "municipios": ("codigo_6d",),
}
# Columns that must be unique.
UNIQUE = (
    ("internacoes", "N_AIH"),
    ("hospital", "CNES"),
    ("mortes", "N_AIH"),
    ("cid10", "CID"),
    ("municipios", "codigo_6d"),
)
# References that must resolve.
RELATIONSHIPS = (
    ("internacoes", "CNES", "hospital", "CNES"),
    ("internacoes", "DIAG_PRINC", "cid10", "CID"),
    ("internacoes", "MUNIC_RES", "municipios", "codigo_6d"),
    ("instrucao", "N_AIH", "internacoes", "N_AIH"),
    ("etnia", "N_AIH", "internacoes", "N_AIH"),
    ("atendimentos", "PROC_REA", "procedimentos", "PROC_REA"),
    ("pernoite", "N_AIH", "internacoes", "N_AIH"),
    ("obstetricos", "N_AIH", "internacoes", "N_AIH"),
    ("mortes", "N_AIH", "internacoes", "N_AIH"),
    ("diagnosticos", "N_AIH", "internacoes", "N_AIH"),
    ("diagnosticos", "DIAG_SECUN", "cid10", "CID"),
    ("cbor", "N_AIH", "internacoes", "N_AIH"),
    ("vincprev", "N_AIH", "internacoes", "N_AIH"),
)
# Accepted codes, ranges (above, up to), code format, towns per hospital.
ACCEPTED = (
    ("internacoes", "SEXO", (1, 3)),
    ("internacoes", "RACA_COR", (1, 2, 3, 4, 5, 99)),
    ("instrucao", "INSTRU", tuple(range(1, 12))),
)
RANGES = (("etnia", "ETNIA", 0, 270), ("internacoes", "NACIONAL", 0, 350))
CODE_FORMAT = r"^[A-Z][0-9]{2,3}(\.[0-9])?\z"
TOWNS_PER_HOSPITAL = 2


def declared_checks() -> list[Check]:
    """Column checks, references and the row rules of the fact table."""
    checks: list[Check] = [not_null(t, c) for t, cols in NOT_NULL.items() for c in cols]
    checks += [accepted_values(t, c, values) for t, c, values in ACCEPTED]
    checks += [within(t, c, above, up_to) for t, c, above, up_to in RANGES]
    checks += fact_checks()
    checks += [UniqueCheck(t, (c,)) for t, c in UNIQUE]
    checks += [RelationshipCheck(t, (c,), pt, (pc,)) for t, c, pt, pc in RELATIONSHIPS]
    checks.append(DistinctPerKeyCheck(FACT, "CNES", "MUNIC_MOV", TOWNS_PER_HOSPITAL))
    return checks


def fact_checks() -> list[Check]:
    admitted, discharged, born = F.col("DT_INTER"), F.col("DT_SAIDA"), F.col("NASC")
    return [
        matches(FACT, "DIAG_PRINC", CODE_FORMAT),
        in_order(FACT, "DT_INTER", "DT_SAIDA"),
        recomputed(FACT, "DIAS_PERM", F.date_diff(discharged, admitted)),
        recomputed(FACT, "IDADE", completed_years(admitted, born), applies=admitted > born),
        non_negative(FACT, ("VAL_SH", "VAL_SP", "VAL_TOT")),
    ]


def written_checks() -> list[Check]:
    """What the written contract asks beyond the declared checks: a positive age."""
    return [RowCheck("positive", FACT, "IDADE", F.col("IDADE") <= 0)]


def key_checks(names: Iterable[str] | None = None) -> list[Check]:
    """Primary keys (present and unique), unique columns and references of the model."""
    checks: list[Check] = []
    names = list(names) if names is not None else list(TABLES)
    for name in names:
        spec = TABLES[name]
        checks += [not_null(name, c) for c in spec.primary_key]
        checks.append(UniqueCheck(name, spec.primary_key, name="primary_key"))
        checks += [UniqueCheck(name, u) for u in spec.uniques]
        checks += [
            RelationshipCheck(name, (r.column,), r.to_table, (r.to_column,), name="foreign_key")
            for r in spec.references
        ]
    return checks


def audit(tables: Mapping[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """Score the checks; one whose table or parent is absent has not passed, and says why."""
    checks = declared_checks() if checks is None else checks
    return scorecard(tables, checks)


__all__ = ["audit", "declared_checks", "fact_checks", "key_checks", "written_checks"]
