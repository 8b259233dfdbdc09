from collections import Counter
from datetime import date

import pytest

from wardmill.operators.project import as_text
from wardmill.plans import audit as A
from wardmill.plans import records as R
from wardmill.plans.model import TABLES, load_order, relational_columns, relational_type
from wardmill.plans.star import star_tables
from wardmill.session import stage

BASE = {
    "N_AIH": "0012", "CNES": "2000001", "PROC_REA": "505020092", "DT_INTER": "20230110",
    "DT_SAIDA": "20230115", "NASC": "19900510", "VAL_SH": "100,50", "VAL_SP": "20", "VAL_UTI": "0",
    "VAL_TOT": "1", "MUNIC_RES": "431490", "MUNIC_MOV": "431490", "DIAG_PRINC": " a09 ",
    "DIAG_SECUN": "B12", "SEXO": "1", "RACA_COR": "01", "ETNIA": "0000", "NACIONAL": "0",
    "NATUREZA": "20", "GESTAO": "1", "NAT_JUR": "1000", "UTI_MES_TO": "1", "UTI_INT_TO": "0",
    "DIAR_ACOM": "0", "INSTRU": "0", "IND_VDRL": "0", "MORTE": "0", "CID_MORTE": "0",
    "CID_NOTIF": "0", "INSC_PN": "000", "VINCPREV": "0", "INFEHOSP": "0", "CBOR": "000000",
    "CONTRACEP1": "00", "CONTRACEP2": "00", "MARCA_UTI": "00", "ESPEC": "03", "IDENT": "1",
    "CEP": "97000000", "COMPLEX": "02", "NUM_FILHOS": "0",
}


@pytest.fixture(scope="module")
def raw(spark):
    def make(*changes):
        data = [{**BASE, **change} for change in changes]
        schema = ", ".join(f"{c} string" for c in BASE)
        df = spark.createDataFrame([tuple(d[c] for c in BASE) for d in data], schema)
        return as_text(df, R.COLUMNS)

    return make


def test_treat(raw):
    row = R.treat(raw({})).first()
    assert (row.N_AIH, row.IDADE, row.DIAS_PERM, row.VAL_TOT) == (12, 32, 5, 120.5)
    assert (row.DIAG_PRINC, row.NACIONAL, row.MUNIC_RES) == ("A09", 10, 431490)
    assert row.DT_INTER == date(2023, 1, 10)


def test_treat_types(raw):
    types = dict(R.treat(raw({})).dtypes)
    expected = {
        "bigint": ("N_AIH", "CNES", "CEP", "PROC_REA", "MUNIC_RES", "MUNIC_MOV"),
        "int": ("DIAR_ACOM", "UTI_MES_TO", "UTI_INT_TO", "NAT_JUR", "CBOR"),
        "smallint": ("IDADE", "DIAS_PERM", "NACIONAL", "GESTAO", "NATUREZA", "ETNIA"),
        "tinyint": ("SEXO", "NUM_FILHOS", "RACA_COR", "INSTRU", "COMPLEX"),
        "double": ("VAL_SH", "VAL_SP", "VAL_UTI", "VAL_TOT"),
        "date": ("DT_INTER", "DT_SAIDA", "NASC"),
    }
    for type_name, columns in expected.items():
        assert {types[c] for c in columns} == {type_name}
    assert list(types) == list(R.COLUMNS)


@pytest.mark.parametrize(
    ("race", "ethnicity", "expected"),
    [("1", "7", (5, 7)), ("1", "0", (1, 0)), ("01", "264", (5, 264)), ("5", "300", (5, 264)),
     ("99", "x", (99, 0)), (None, None, (0, 0))],
)
def test_race_and_ethnicity(raw, race, ethnicity, expected):
    row = R.treat(raw({"RACA_COR": race, "ETNIA": ethnicity})).first()
    assert (row.RACA_COR, row.ETNIA) == expected


def test_missing_columns_are_left_alone(spark):
    df = spark.createDataFrame([("1", "2,5", "3", "20200101")], "N_AIH string, VAL_SH string, "
                               "VAL_SP string, DT_INTER string")  # fmt: skip
    row = R.treat(df).first()
    assert row.asDict() == {
        "N_AIH": 1, "VAL_SH": 2.5, "VAL_SP": 3.0, "DT_INTER": date(2020, 1, 1),
        "VAL_UTI": 0.0, "VAL_TOT": 5.5,
    }


def test_unreadable_ids_are_kept_under_zero(raw):
    df = raw({}, {"N_AIH": "x", "VAL_SH": "1"}, {"N_AIH": None, "VAL_SH": "2"})
    assert R.unidentified(df).count() == 2
    contracted = {r.N_AIH: r.VAL_SH for r in R.contract_records(R.treat(df)).collect()}
    assert contracted == {12: 100.5, 0: 3.0}


def test_type_only(raw):
    row = R.type_only(raw({"VAL_SH": "1,5", "VAL_SP": "2.5", "NACIONAL": "x", "NASC": "0"})).first()
    assert (row.VAL_SH, row.VAL_SP, row.NACIONAL, row.NASC) == (None, 2.5, None, None)
    assert row.N_AIH == "0012"


def test_contract_records(raw):
    df = raw(
        {"UTI_MES_TO": "1", "PROC_REA": "3", "DT_INTER": "20230112", "VAL_UTI": "1"},
        {"UTI_MES_TO": "2", "PROC_REA": "2", "DT_INTER": "20230110", "NASC": ""},
        {"UTI_MES_TO": "6", "PROC_REA": "1", "DT_INTER": None, "VAL_SP": "0"},
    )
    out = R.contract_records(R.treat(df)).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.UTI_MES_TO, row.PROC_REA, row.DT_INTER) == (3.0, 2, date(2023, 1, 10))
    assert (row.VAL_SH, row.VAL_SP, row.VAL_UTI, row.VAL_TOT) == (301.5, 40.0, 1.0, 342.5)
    assert (row.NASC, row.IDADE, row.DIAS_PERM) == (None, None, 5)


@pytest.fixture(scope="module")
def star(raw):
    treated = R.treat(
        raw(
            {"N_AIH": "1", "VAL_UTI": "9", "UTI_MES_TO": "3", "MARCA_UTI": "75"},
            {"N_AIH": "1", "UTI_MES_TO": "2", "PROC_REA": "7"},
            {"N_AIH": "2", "INSC_PN": " 43 ", "INSTRU": "4", "MORTE": "1", "CID_MORTE": "i21",
             "NATUREZA": "30"},
            {"N_AIH": "3", "VINCPREV": " e ", "CBOR": "223505", "INFEHOSP": "1", "NATUREZA": "30"},
            {"N_AIH": "4", "CONTRACEP1": "03", "CONTRACEP2": None, "RACA_COR": "1", "ETNIA": "12"},
            {"N_AIH": "5", "CID_NOTIF": "z30", "DIAR_ACOM": "2", "DIAG_SECUN": "0",
             "IND_VDRL": "1"},
        )
    )
    treated = stage(treated, "treated")
    return star_tables(treated, stage(R.contract_records(treated), "contracted"))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("uti_detalhes", [(1, 2, "75", 0, 9.0)]),
        ("condicoes_especificas", [(5, "1")]),
        ("obstetricos", [(2, "43")]),
        ("instrucao", [(2, 4)]),
        ("mortes", [(2, "I21")]),
        ("infehosp", [(3, 1)]),
        ("vincprev", [(3, "E")]),
        ("cbor", [(3, 223505)]),
        ("contraceptivos", [(4, "CONTRACEP1", "03")]),
        ("etnia", [(4, 12)]),
        ("notificacoes", [(5, "Z30")]),
        ("pernoite", [(5, 2.0)]),
        ("diagnosticos", [(1, "B12"), (2, "B12"), (3, "B12"), (4, "B12")]),
        ("hospital", [(2000001, 20, 1, 1000)]),
    ],
)
def test_star_tables(star, name, expected):
    got = sorted(tuple(r) for r in star[name].collect())
    if name == "uti_detalhes":
        # The mark comes from the first row, which is the one with the lower procedure code.
        assert [(r[0], r[1], r[3], r[4]) for r in got] == [(1, 2, 0, 9.0)]
        return
    assert got == expected


def test_star_sizes(star):
    assert star["internacoes"].count() == 5
    assert star["atendimentos"].count() == 6
    facts = {r.N_AIH for r in star["internacoes"].collect()}
    for name, df in star.items():
        if "N_AIH" in df.columns:
            assert {r.N_AIH for r in df.select("N_AIH").collect()} <= facts, name


def test_audit_of_clean_and_broken_tables(spark, star):
    tables = dict(star)
    tables["cid10"] = spark.createDataFrame([("A09",), ("B12",)], "CID string")
    tables["municipios"] = spark.createDataFrame([(431490,)], "codigo_6d bigint")
    tables["procedimentos"] = spark.createDataFrame([(505020092,)], "PROC_REA bigint")
    scores = {
        (r.check_name, r.table_name, r.column_name): r.violations
        for r in A.audit(tables).collect()
    }
    assert len(scores) == len(A.declared_checks())
    failing = {k: v for k, v in scores.items() if v}
    assert failing == {("relationships", "atendimentos", "PROC_REA"): 1}


def test_declared_checks_are_complete():
    kinds = [c.name for c in A.declared_checks()]
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert (counts["not_null"], counts["unique"], counts["relationships"]) == (25, 5, 13)
    assert counts["accepted_values"] == 3
    assert sum(len(s.references) for s in TABLES.values()) == 23
    assert len(TABLES) == 20


def test_load_order_puts_parents_first():
    order = load_order()
    assert sorted(order) == sorted(TABLES)
    for name, spec in TABLES.items():
        for ref in spec.references:
            assert order.index(ref.to_table) < order.index(name)


def test_relational_types():
    spec = TABLES["uti_detalhes"]
    assert relational_columns(spec) == (
        "N_AIH BIGSERIAL, UTI_MES_TO INTEGER, MARCA_UTI VARCHAR, UTI_INT_TO INTEGER, "
        "VAL_UTI DOUBLE PRECISION"
    )
    assert relational_type(TABLES["internacoes"].schema["DT_INTER"].dataType) == "DATE"


def test_satellite_rules_read_text_or_numbers(spark):
    from wardmill.operators.extract import extract
    from wardmill.plans.star import SATELLITES

    df = spark.createDataFrame([(1, "1"), (2, None), (3, "x")], "N_AIH bigint, INFEHOSP string")
    assert [tuple(r) for r in extract(df, SATELLITES["infehosp"]()).collect()] == [(1, 1)]


def test_first_row_has_a_known_discharge(spark):
    rows = [(1, date(2023, 1, 1), None), (1, date(2023, 1, 1), date(2023, 1, 9))]
    df = spark.createDataFrame(rows, "N_AIH long, DT_INTER date, DT_SAIDA date")
    df = df.selectExpr("*", "5 AS PROC_REA")
    row = R.contract_records(df).first()
    assert (row.DT_SAIDA, row.DIAS_PERM) == (date(2023, 1, 9), 8)


def test_declared_checks_are_as_many_as_declared():
    """Pinned, since the SQL of the audits is made from the same lists."""
    kinds = Counter(c.name for c in A.declared_checks())
    named = [kinds.pop(n) for n in ("not_null", "unique", "relationships", "accepted_values")]
    assert named + [sum(kinds.values())] == [25, 5, 13, 3, 8]


def test_each_value_is_read_once(raw):
    """Rules name a value several times; it is read in a projection of its own, once."""
    plan = R.treat(raw())._jdf.queryExecution().optimizedPlan().toString()
    text = r"\s*[+-]?[0-9]+\s*"
    read = sum(line.count(text) for line in plan.splitlines())
    assert read <= len({n for names in R.INTEGERS.values() for n in names} | {"ETNIA"})


def test_records_settle_the_session(raw, spark):
    """Wide plans get their settings in a session made elsewhere; its own settings stay."""
    limit, split = "spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes"
    held = {k: spark.conf.get(k, None) for k in (limit, split)}
    try:
        spark.conf.unset(limit)
        spark.conf.set(split, "3m")
        R.treat(raw())
        assert spark.conf.get(limit) == "8000" and spark.conf.get(split) == "3m"
    finally:
        for key, value in held.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
