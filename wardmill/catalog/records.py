"""The record stages over admission records derived from every billing line."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmill.catalog.common import (
    PRICE_DAYS,
    PRICE_TEXT,
    QUANTITY,
    SHIP_DAY,
    day_text,
    derive,
    derive_sql,
    lines,
    sql_age,
    sql_clip,
    sql_code,
    sql_date,
    sql_int,
    sql_money,
    sql_region,
    sql_strip,
    table,
)
from wardmill.catalog.shaping import mode_sql
from wardmill.operators.profile import dataset_diff
from wardmill.operators.project import as_text, union_as_text
from wardmill.plans.audit import audit, declared_checks, key_checks, written_checks
from wardmill.plans.model import FACT, TABLES, load_order
from wardmill.plans.records import COLUMNS, CODES, contract_records, treat, type_only, unidentified
from wardmill.plans.star import FACT_COLUMNS, HOSPITAL_ATTRIBUTES, star_table, star_tables
from wardmill.session import stage
from wardmill.sinks.writers import prepare

QUERIES = {}
ORACLE = {}

_Q2 = f"LPAD(CAST({QUANTITY} AS STRING), 2, '0')"
_LINE = "CAST(l_linenumber AS STRING)"


def _money_text(amount: str) -> str:
    return f"REPLACE(CAST(CAST({amount} AS DECIMAL(18,2)) AS STRING), '.', ',')"


# Raw text columns by SQL expressions over one line; the columns left out are missing.
RAW = {
    "ESPEC": f"LPAD({_LINE}, 2, '0')",
    "N_AIH": "CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 'SEM NUMERO' "
    "ELSE LPAD(CAST(l_orderkey AS STRING), 13, '0') END",
    "IDENT": "CASE WHEN l_returnflag = 'R' THEN '5' ELSE '1' END",
    "CEP": "CAST(90000000 + l_partkey AS STRING)",
    "MUNIC_RES": "CASE WHEN l_discount = 0.0 THEN NULL WHEN l_discount = 0.01 THEN '5300108' "
    f"WHEN l_discount = 0.02 THEN ' ' || CAST(430000 + {QUANTITY} AS STRING) || '2 ' "
    f"WHEN l_discount = 0.03 THEN 'x' ELSE CAST(430000 + {QUANTITY} AS STRING) END",
    "NASC": "CASE WHEN l_tax = 0.0 THEN '' WHEN l_tax = 0.01 THEN '20230230' "
    f"WHEN l_tax = 0.02 THEN {day_text(f'({SHIP_DAY} + 30)')} "
    f"ELSE {day_text(f'({SHIP_DAY} - {PRICE_DAYS})')} END",
    "SEXO": "CASE WHEN l_returnflag = 'A' THEN '1' WHEN l_returnflag = 'N' THEN '3' "
    "WHEN l_discount > 0.05 THEN '9' ELSE '300' END",
    "DT_INTER": f"CASE WHEN l_tax = 0.05 THEN NULL ELSE {day_text(SHIP_DAY)} END",
    "DT_SAIDA": f"CASE WHEN l_tax = 0.03 THEN NULL WHEN l_tax = 0.04 "
    f"THEN {day_text(f'({SHIP_DAY} - 2)')} ELSE {day_text(f'({SHIP_DAY} + {QUANTITY})')} END",
    "UTI_MES_TO": f"CASE WHEN l_linestatus = 'O' THEN CAST({QUANTITY} AS STRING) ELSE 'x' END",
    "MARCA_UTI": "CASE WHEN l_linestatus = 'O' THEN '75' ELSE '00' END",
    "UTI_INT_TO": _LINE,
    "DIAR_ACOM": f"CASE WHEN l_returnflag = 'N' THEN {_LINE} ELSE '0' END",
    "PROC_REA": "CASE WHEN l_discount = 0.07 THEN '-5' WHEN l_discount = 0.08 THEN 'abc' "
    "ELSE CAST(505000000 + l_partkey AS STRING) END",
    "VAL_SH": f"CASE WHEN l_tax = 0.06 THEN '- ' || {PRICE_TEXT} WHEN l_tax = 0.07 "
    f"THEN '1.' || {_money_text('l_extendedprice')} ELSE {_money_text('l_extendedprice')} END",
    "VAL_SP": _money_text("l_quantity * l_tax"),
    "VAL_TOT": "'0'",
    "VAL_UTI": f"CASE WHEN l_linestatus = 'O' THEN {_money_text('l_quantity * 10')} END",
    "NATUREZA": f"LPAD({_LINE}, 2, '0')",
    "CNES": "CAST(2000000 + l_suppkey AS STRING)",
    "NAT_JUR": f"CAST(1000 + {QUANTITY} AS STRING)",
    "GESTAO": "CASE WHEN l_returnflag = 'A' THEN '1' ELSE '2' END",
    "IND_VDRL": "CASE WHEN l_discount >= 0.09 THEN '1' ELSE '0' END",
    "IDADE": "'99'",
    "DIAG_PRINC": f"CASE WHEN l_discount = 0.04 THEN NULL WHEN l_discount = 0.05 THEN '000' "
    f"ELSE ' ' || LOWER(l_returnflag) || {_Q2} || chr(9) END",
    "DIAG_SECUN": f"CASE WHEN l_discount = 0.06 THEN '  ' WHEN l_discount = 0.07 THEN '0A' "
    f"ELSE l_returnflag || {_Q2} END",
    "MORTE": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1' ELSE '0' END",
    "MUNIC_MOV": f"CAST(430000 + l_linenumber AS STRING) || '9'",
    "DIAS_PERM": "'0'",
    "NACIONAL": f"CASE WHEN l_linenumber = 1 THEN '0' WHEN l_linenumber = 2 THEN '999' "
    f"ELSE CAST({QUANTITY} AS STRING) END",
    "NUM_FILHOS": _LINE,
    "INSTRU": f"CASE WHEN l_linenumber <= 4 THEN NULL ELSE CAST({QUANTITY} AS STRING) END",
    "CID_NOTIF": f"CASE WHEN l_discount >= 0.08 THEN ' z' || {_Q2} ELSE '0000' END",
    "CONTRACEP1": f"CASE WHEN l_tax = 0.0 THEN NULL WHEN l_tax = 0.01 THEN {_Q2} ELSE '00' END",
    "CONTRACEP2": f"CASE WHEN l_tax = 0.01 THEN '00' WHEN l_tax = 0.02 THEN {_Q2} ELSE '00' END",
    "INSC_PN": f"CASE WHEN l_linenumber = 1 THEN ' 000 ' WHEN l_linenumber = 2 THEN NULL "
    f"WHEN l_linenumber = 3 THEN '0' ELSE ' 43' || {_Q2} || chr(9) END",
    "CBOR": "CASE WHEN l_discount = 0.09 THEN '223505' WHEN l_discount = 0.1 THEN 'abc' "
    "ELSE '000000' END",
    "CNAER": "'000'",
    "VINCPREV": "CASE WHEN l_returnflag = 'A' THEN ' e ' WHEN l_returnflag = 'N' THEN '00' END",
    "INFEHOSP": "CASE WHEN l_tax = 0.08 THEN '1' WHEN l_tax = 0.07 THEN '' ELSE '0' END",
    "CID_ASSO": "''",
    "CID_MORTE": f"CASE WHEN l_returnflag = 'R' THEN 'r' || {_Q2} ELSE '0' END",
    "COMPLEX": "CASE WHEN l_linestatus = 'O' THEN '02' ELSE '03' END",
    "RACA_COR": f"CASE WHEN l_linenumber = 6 THEN '99' ELSE '0' || {_LINE} END",
    "ETNIA": "CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_quantity * 6 AS INT) AS STRING) "
    "ELSE '0000' END",
}


def raw_records(spark, sf_dir):
    """46 text columns; those not derived are filled in as null by the canonical projection."""
    return as_text(derive(lines(spark, sf_dir), RAW), COLUMNS)


RAW_SQL = derive_sql({**RAW, "GESTRICO": "CAST(NULL AS STRING)"}, "lineitem")

# What each treated column must be, written as SQL over the raw text.
_TREATED = {c: c for c in COLUMNS}
_TREATED.update({c: sql_int(c, "BIGINT") for c in ("N_AIH", "CNES", "CEP")})
_TREATED.update(
    {c: sql_int(c, "INTEGER") for c in ("DIAR_ACOM", "UTI_MES_TO", "UTI_INT_TO", "NAT_JUR", "CBOR")}
)
_TREATED.update({c: sql_int(c, "SMALLINT") for c in ("GESTAO", "NATUREZA")})
_TREATED.update({c: sql_int(c, "TINYINT") for c in ("SEXO", "NUM_FILHOS", "INSTRU", "COMPLEX")})
_TREATED.update({c: sql_money(c) for c in ("VAL_SH", "VAL_SP", "VAL_UTI")})
_TREATED.update({c: sql_date(c) for c in ("DT_INTER", "DT_SAIDA", "NASC")})
_TREATED.update({c: sql_region(c) for c in ("MUNIC_RES", "MUNIC_MOV")})
_TREATED.update({c: sql_code(c) for c in CODES})
_TREATED["PROC_REA"] = f"greatest({sql_int('PROC_REA', 'BIGINT')}, 0)"
_NATIONAL = sql_int("NACIONAL", "SMALLINT")
_TREATED["NACIONAL"] = (
    f"CAST(least(CASE WHEN {_NATIONAL} = 0 THEN 10 ELSE greatest({_NATIONAL}, 0) END, 350) "
    "AS SMALLINT)"
)
_ETHNIC = sql_clip(sql_int("ETNIA", "SMALLINT"), 0, 264)
_RACE = sql_clip(sql_int("RACA_COR", "TINYINT"), 0, 99)
_TREATED["ETNIA"] = f"CAST({_ETHNIC} AS SMALLINT)"
_TREATED["RACA_COR"] = (
    f"CAST(CASE WHEN {_RACE} <> 5 AND {_ETHNIC} <> 0 THEN 5 ELSE {_RACE} END AS TINYINT)"
)
_DERIVED = {
    "VAL_TOT": "VAL_SH + VAL_SP + VAL_UTI",
    "DIAS_PERM": "COALESCE(TRY_CAST(date_diff('day', DT_INTER, DT_SAIDA) AS SMALLINT), 0)",
    "IDADE": f"CAST({sql_age('DT_INTER', 'NASC')} AS SMALLINT)",
}


def _columns_sql(overrides, prefix="") -> str:
    return ", ".join(
        f"{overrides[c]} AS {c}" if c in overrides else f"{prefix}{c}" for c in COLUMNS
    )


_PLAIN = {c: e for c, e in _TREATED.items() if c not in _DERIVED}
TREATED_SQL = (
    f"SELECT {_columns_sql(_DERIVED)} FROM (SELECT "
    f"{', '.join(f'{e} AS {c}' for c, e in _PLAIN.items())} FROM ({RAW_SQL}))"
)


def _money_rounded(df, columns=("VAL_SH", "VAL_SP", "VAL_TOT", "VAL_UTI")):
    """Cents and average days without the last binary digits, which depend on adding order."""
    means = ("UTI_MES_TO", "UTI_INT_TO", "DIAR_ACOM")
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(
        *[
            F.round(c, 2 if c in columns else 6).alias(c)
            if c in doubles and c in (*columns, *means)
            else F.col(c)
            for c in df.columns
        ]
    )


def _rounded_sql(columns, doubles) -> str:
    return ", ".join(
        f"round({c}, {2 if c.startswith('VAL_') else 6}) AS {c}" if c in doubles else c
        for c in columns
    )


def treat_records(spark, sf_dir):
    return _money_rounded(treat(raw_records(spark, sf_dir)))


QUERIES["treat_records"] = treat_records
_MONEY = ("VAL_SH", "VAL_SP", "VAL_TOT", "VAL_UTI")
_MEANS = ("UTI_MES_TO", "UTI_INT_TO", "DIAR_ACOM")
ORACLE["treat_records"] = f"SELECT {_rounded_sql(COLUMNS, _MONEY)} FROM ({TREATED_SQL})"


def type_only_records(spark, sf_dir):
    return type_only(raw_records(spark, sf_dir)).select(
        "N_AIH", "VAL_SH", "VAL_SP", "VAL_UTI", "DT_INTER", "DT_SAIDA", "NASC", "NACIONAL",
        "NUM_FILHOS", "ETNIA",
    )


def _typed(column: str, type_name: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+(\\.[0-9]+)?') "
        f"THEN TRY_CAST(trim({column}) AS {type_name}) END AS {column}"
    )


QUERIES["type_only_records"] = type_only_records
ORACLE["type_only_records"] = f"""
SELECT N_AIH, {", ".join(_typed(c, "DOUBLE") for c in ("VAL_SH", "VAL_SP", "VAL_UTI"))},
       {", ".join(f"{sql_date(c)} AS {c}" for c in ("DT_INTER", "DT_SAIDA", "NASC"))},
       {_typed("NACIONAL", "SMALLINT")}, {_typed("NUM_FILHOS", "TINYINT")},
       {_typed("ETNIA", "TINYINT")}
FROM ({RAW_SQL})"""


_TYPE_ONLY = (
    "VAL_SH", "VAL_SP", "VAL_UTI", "DT_INTER", "DT_SAIDA", "NASC", "NACIONAL", "NUM_FILHOS", "ETNIA",
)


def record_versions_diff(spark, sf_dir):
    """Cleaned against type-only records, by case id."""
    raw = raw_records(spark, sf_dir)
    columns = ("N_AIH", *_TYPE_ONLY)
    return dataset_diff(treat(raw).select(*columns), type_only(raw).select(*columns), ["N_AIH"])


_VERSION_PAIRS_SQL = f"""
SELECT count(*) AS n, {", ".join(f"count(*) FILTER (WHERE a.{c} = b.{c}) AS {c}" for c in _TYPE_ONLY)}
FROM ({TREATED_SQL}) a JOIN ({ORACLE["type_only_records"]}) b
  ON regexp_full_match(trim(b.N_AIH), '[+-]?[0-9]+') AND a.N_AIH = TRY_CAST(trim(b.N_AIH) AS BIGINT)"""
QUERIES["dataset_diff_records"] = record_versions_diff
ORACLE["dataset_diff_records"] = f"WITH p AS MATERIALIZED ({_VERSION_PAIRS_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS DECIMAL(38,0)) AS equal,
        CAST(n - {c} AS DECIMAL(38,0)) AS different,
        round(100.0 * {c} / n, 2) AS percent_equal FROM p"""
    for c in _TYPE_ONLY
)

# The same records as writers leave them: as text, as integers, and as doubles.
MIXED = {
    "N_AIH": "4323100000000 + l_orderkey",
    "CNES": "2000000 + l_partkey",
    "UTI_MES_TO": "l_linenumber",
    "VAL_SH": "CASE WHEN l_linenumber = 1 THEN ROUND(l_extendedprice / 100000000, 10) ELSE l_extendedprice END",
}
_AS = {
    "text": {c: f"CAST({MIXED[c]} AS STRING)" for c in ("N_AIH", "CNES", "UTI_MES_TO")}
    | {"VAL_SH": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)"},
    "whole": {c: f"CAST({MIXED[c]} AS BIGINT)" for c in ("N_AIH", "CNES", "UTI_MES_TO")}
    | {"VAL_SH": "CAST(floor(l_extendedprice) AS BIGINT)"},
    "double": {c: f"CAST({e} AS DOUBLE)" for c, e in MIXED.items()},
}


def treat_mixed_types(spark, sf_dir):
    """Cleaned records of raw frames that differ in type only; every id, count and amount stays."""
    frames = [derive(lines(spark, sf_dir), columns) for columns in _AS.values()]
    return treat(union_as_text(frames, MIXED)).select(*MIXED)


QUERIES["treat_mixed_types"] = treat_mixed_types
ORACLE["treat_mixed_types"] = " UNION ALL ".join(
    f"SELECT CAST({MIXED['N_AIH']} AS BIGINT) AS N_AIH, CAST({MIXED['CNES']} AS BIGINT) AS CNES, "
    f"CAST({MIXED['UTI_MES_TO']} AS INTEGER) AS UTI_MES_TO, CAST({columns['VAL_SH']} AS DOUBLE) "
    "AS VAL_SH FROM lineitem"
    for columns in _AS.values()
)


def unidentified_records(spark, sf_dir):
    return unidentified(raw_records(spark, sf_dir)).select("N_AIH", "CNES", "PROC_REA", "VAL_SH")


QUERIES["unidentified_records"] = unidentified_records
ORACLE["unidentified_records"] = f"""
SELECT N_AIH, CNES, PROC_REA, VAL_SH FROM ({RAW_SQL})
WHERE NOT regexp_full_match(trim(N_AIH), '[+-]?[0-9]+')"""

_SUMMED = ("VAL_SH", "VAL_SP", "VAL_UTI")
_CARRIED = [c for c in COLUMNS if c not in ("N_AIH", *_SUMMED, *_MEANS, *_DERIVED)]
_FIRST_ORDER = ["DT_INTER", "DT_SAIDA", "PROC_REA"]
_RANKED = ["DT_INTER IS NULL", "DT_INTER", "DT_SAIDA IS NULL", "DT_SAIDA", "PROC_REA"] + [
    f"{c} ASC NULLS FIRST" for c in _CARRIED if c not in _FIRST_ORDER
]
CONTRACTED_SQL = f"""
SELECT {_columns_sql(_DERIVED)} FROM (
    SELECT t.*, {", ".join(f"f.{c}" for c in _CARRIED)}
    FROM (SELECT N_AIH, {", ".join(f"sum({c}) AS {c}" for c in _SUMMED)},
                 {", ".join(f"avg({c}) AS {c}" for c in _MEANS)}
          FROM treated GROUP BY N_AIH) t
    JOIN (SELECT *, row_number() OVER (PARTITION BY N_AIH ORDER BY {", ".join(_RANKED)}) AS rn
          FROM treated) f
      ON f.N_AIH = t.N_AIH AND f.rn = 1)"""
STAGES_SQL = f"""WITH treated AS MATERIALIZED ({TREATED_SQL}),
contracted AS MATERIALIZED ({CONTRACTED_SQL})"""


def _stages(spark, sf_dir):
    treated = treat(raw_records(spark, sf_dir))
    return treated, contract_records(treated)


def contracted_records(spark, sf_dir):
    return _money_rounded(_stages(spark, sf_dir)[1])


QUERIES["contract_records"] = contracted_records
ORACLE["contract_records"] = (
    f"{STAGES_SQL} SELECT {_rounded_sql(COLUMNS, (*_MONEY, *_MEANS))} FROM contracted"
)

# The star tables, written as SQL over the contracted records.
STAR_SQL = {
    FACT: f"SELECT {', '.join(FACT_COLUMNS)} FROM contracted",
    "uti_detalhes": f"""SELECT N_AIH, CAST(trunc(UTI_MES_TO) AS INTEGER) AS UTI_MES_TO, MARCA_UTI,
        CAST(trunc(UTI_INT_TO) AS INTEGER) AS UTI_INT_TO, VAL_UTI
        FROM contracted WHERE VAL_UTI > 0""",
    "condicoes_especificas": f"SELECT N_AIH, IND_VDRL FROM contracted WHERE IND_VDRL = '1'",
    "obstetricos": f"""SELECT N_AIH, INSC_PN FROM (
        SELECT N_AIH, {sql_strip("INSC_PN")} AS INSC_PN FROM contracted)
        WHERE NOT regexp_full_match(INSC_PN, '0*')""",
    "instrucao": f"SELECT N_AIH, INSTRU FROM contracted WHERE INSTRU <> 0",
    "mortes": f"SELECT N_AIH, CID_MORTE FROM contracted WHERE MORTE = '1'",
    "infehosp": f"""SELECT N_AIH, INFEHOSP FROM (
        SELECT N_AIH, CAST({sql_int("INFEHOSP", "INTEGER")} AS INTEGER) AS INFEHOSP
        FROM contracted) WHERE INFEHOSP = 1""",
    "vincprev": f"""SELECT N_AIH, VINCPREV FROM (
        SELECT N_AIH, upper({sql_strip("VINCPREV")}) AS VINCPREV FROM contracted)
        WHERE NOT regexp_full_match(VINCPREV, '0*')""",
    "cbor": f"SELECT N_AIH, CBOR FROM contracted WHERE CBOR > 0",
    "etnia": f"""SELECT DISTINCT N_AIH, CAST(ETNIA AS INTEGER) AS ETNIA FROM contracted
        WHERE RACA_COR = 5 AND ETNIA > 0""",
    "notificacoes": f"SELECT N_AIH, CID_NOTIF FROM contracted WHERE CID_NOTIF <> '0'",
    "pernoite": f"SELECT N_AIH, DIAR_ACOM FROM contracted WHERE DIAR_ACOM > 0",
    "diagnosticos": f"""SELECT DISTINCT N_AIH, DIAG_SECUN FROM contracted
        WHERE NOT starts_with(DIAG_SECUN, '0')""",
    "contraceptivos": " UNION ALL ".join(
        f"SELECT N_AIH, '{c}' AS TIPO, {c} AS CODIGO_METODO FROM contracted "
        f"WHERE {c} <> '00'"
        for c in ("CONTRACEP1", "CONTRACEP2")
    ),
    "hospital": mode_sql("CNES", HOSPITAL_ATTRIBUTES, f"contracted"),
    "atendimentos": f"SELECT N_AIH, PROC_REA FROM treated",
}


def _star_query(name):
    def query(spark, sf_dir):
        return _money_rounded(star_table(name, *_stages(spark, sf_dir)))

    return query


for _name, _sql in STAR_SQL.items():
    _columns = {
        "uti_detalhes": TABLES["uti_detalhes"].schema.names,
        "pernoite": ["N_AIH", "DIAR_ACOM"],
        FACT: FACT_COLUMNS,
    }.get(_name)
    QUERIES[f"star_{_name}"] = _star_query(_name)
    ORACLE[f"star_{_name}"] = (
        f"{STAGES_SQL} {_sql}"
        if _columns is None
        else f"{STAGES_SQL} SELECT {_rounded_sql(_columns, (*_MONEY, 'DIAR_ACOM'))} FROM ({_sql})"
    )

# Lookup tables from the given ones, so that some references resolve and some do not.
LOOKUPS = {
    "procedimentos": (
        "part",
        {"PROC_REA": "505000000 + p_partkey", "NOME_PROC": "p_name"},
    ),
    "municipios": (
        "nation",
        {
            "codigo_6d": "CAST(430000 + n_nationkey AS BIGINT)",
            "codigo_ibge": "CAST(4300000 + n_regionkey AS BIGINT)",
            "nome": "n_name",
        },
    ),
    "cid10": (
        "part",
        {"CID": "'A' || LPAD(CAST(p_size AS STRING), 2, '0')", "CD_DESCRICAO": "p_type"},
    ),
}


def star_schema(spark, sf_dir):
    """Every table as it is loaded: declared columns and types, services with their id.

    The treated and contracted records are written once, since every table reads one of them, and so
    are the hospitals, which several checks read.
    """
    treated = stage(treat(raw_records(spark, sf_dir)), "treated")
    tables = star_tables(treated, stage(contract_records(treated), "contracted"))
    tables["hospital"] = stage(tables["hospital"], "hospital")
    for name, (source, columns) in LOOKUPS.items():
        tables[name] = derive(table(spark, sf_dir, source), columns)
    return {name: prepare(df, name) for name, df in tables.items()}


def star_audit(spark, sf_dir):
    return audit(star_schema(spark, sf_dir), declared_checks() + written_checks())


def star_key_audit(spark, sf_dir):
    tables = star_schema(spark, sf_dir)
    return audit(tables, key_checks(load_order(tables)))


def _loaded_sql() -> str:
    """Every star and lookup table as a named intermediate result."""
    tables = dict(STAR_SQL)
    tables["atendimentos"] = (
        f"SELECT row_number() OVER () AS id_atendimento, x.* FROM ({tables['atendimentos']}) x"
    )
    tables.update({n: derive_sql(columns, source) for n, (source, columns) in LOOKUPS.items()})
    return ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in tables.items())


def _rows_check(name, table_name, column, condition):
    return (
        f"SELECT '{name}' AS check_name, '{table_name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS violations, count(*) = 0 AS passed FROM {table_name} x "
        f"WHERE {condition}"
    )


def _keys_check(name, table_name, column, key, having):
    return (
        f"SELECT '{name}' AS check_name, '{table_name}' AS table_name, '{column}' AS column_name, "
        f"count(*) AS violations, count(*) = 0 AS passed FROM (SELECT {key} "
        f"FROM {table_name} x WHERE {key} IS NOT NULL GROUP BY {key} HAVING {having})"
    )


def _without_reason(parts) -> str:
    return f"SELECT *, CAST(NULL AS VARCHAR) AS reason FROM ({' UNION ALL '.join(parts)})"


def _audit_sql() -> str:
    from wardmill.plans.audit import (
        ACCEPTED,
        CODE_FORMAT,
        NOT_NULL,
        RANGES,
        RELATIONSHIPS,
        TOWNS_PER_HOSPITAL,
        UNIQUE,
    )

    age = sql_age("DT_INTER", "NASC")
    parts = [
        _rows_check("not_null", t, c, f"{c} IS NULL") for t, cols in NOT_NULL.items() for c in cols
    ]
    parts += [
        _rows_check("accepted_values", t, c, f"{c} NOT IN ({', '.join(map(str, v))})")
        for t, c, v in ACCEPTED
    ]
    parts += [
        _rows_check("range", t, c, f"{c} <= {above} OR {c} > {up_to}")
        for t, c, above, up_to in RANGES
    ]
    parts += [
        _rows_check(
            "format", FACT, "DIAG_PRINC", f"NOT regexp_matches(DIAG_PRINC, '{CODE_FORMAT}')"
        ),
        _rows_check("date_order", FACT, "DT_INTER..DT_SAIDA", "DT_SAIDA < DT_INTER"),
        _rows_check(
            "recompute", FACT, "DIAS_PERM", "DIAS_PERM <> date_diff('day', DT_INTER, DT_SAIDA)"
        ),
        # The stored age is bounded at 150, the check recomputes it without the bound.
        _rows_check(
            "recompute",
            FACT,
            "IDADE",
            f"DT_INTER > NASC AND IDADE <> {age.replace('> 150 THEN 150', '> 9999 THEN 0')}",
        ),
        _rows_check(
            "non_negative", FACT, "VAL_SH+VAL_SP+VAL_TOT", "VAL_SH < 0 OR VAL_SP < 0 OR VAL_TOT < 0"
        ),
    ]
    parts += [_keys_check("unique", t, c, c, "count(*) > 1") for t, c in UNIQUE]
    parts += [
        _rows_check(
            "relationships",
            t,
            c,
            f"x.{c} IS NOT NULL AND x.{c} NOT IN (SELECT {pc} FROM {pt} p)",
        )
        for t, c, pt, pc in RELATIONSHIPS
    ]
    parts.append(
        _keys_check(
            "distinct_per_key",
            FACT,
            "MUNIC_MOV",
            "CNES",
            f"count(DISTINCT MUNIC_MOV) > {TOWNS_PER_HOSPITAL}",
        )
    )
    parts.append(_rows_check("positive", FACT, "IDADE", "IDADE <= 0"))
    return f"{STAGES_SQL}, {_loaded_sql()} {_without_reason(parts)}"


def _key_audit_sql() -> str:
    names = [n for n in TABLES if n in STAR_SQL or n in LOOKUPS]
    parts = []
    for name in names:
        spec = TABLES[name]
        key = ", ".join(spec.primary_key)
        known = " AND ".join(f"{c} IS NOT NULL" for c in spec.primary_key)
        parts += [_rows_check("not_null", name, c, f"{c} IS NULL") for c in spec.primary_key]
        parts.append(
            f"SELECT 'primary_key' AS check_name, '{name}' AS table_name, "
            f"'{'+'.join(spec.primary_key)}' AS column_name, count(*) AS violations, "
            f"count(*) = 0 AS passed FROM (SELECT {key} FROM {name} x WHERE {known} "
            f"GROUP BY {key} HAVING count(*) > 1)"
        )
        parts += [_keys_check("unique", name, u[0], u[0], "count(*) > 1") for u in spec.uniques]
        parts += [
            _rows_check(
                "foreign_key",
                name,
                r.column,
                f"x.{r.column} IS NOT NULL AND x.{r.column} NOT IN "
                f"(SELECT {r.to_column} FROM {r.to_table} p)",
            )
            for r in spec.references
        ]
    return f"{STAGES_SQL}, {_loaded_sql()} {_without_reason(parts)}"


QUERIES["star_audit"] = star_audit
ORACLE["star_audit"] = _audit_sql()
QUERIES["star_key_audit"] = star_key_audit
ORACLE["star_key_audit"] = _key_audit_sql()
