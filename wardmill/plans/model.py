"""The star schema: column types, keys and references of its 20 tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, SHORT, BYTE = T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType()
TEXT, DATE, FLOAT, DOUBLE = T.StringType(), T.DateType(), T.FloatType(), T.DoubleType()


@dataclass(frozen=True)
class Reference:
    column: str
    to_table: str
    to_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    primary_key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    uniques: tuple[tuple[str, ...], ...] = ()
    generated_id: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns])


# Names of the case id and of the tables most references point to.
CASE = "N_AIH"
FACT = "internacoes"
TO_CASE = Reference(CASE, FACT, CASE)


def _satellite(name: str, *columns: tuple[str, T.DataType], key=(CASE,), refs=()) -> TableSpec:
    return TableSpec(name, ((CASE, LONG), *columns), key, (TO_CASE, *refs))


# The tables, their columns, types, keys and references.
# Money keeps its cents here (double), where integer columns would lose them.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("cid10", (("CID", TEXT), ("CD_DESCRICAO", TEXT)), ("CID",)),
        TableSpec(
            "municipios",
            (
                ("codigo_6d", LONG),
                ("codigo_ibge", LONG),
                ("nome", TEXT),
                ("latitude", FLOAT),
                ("longitude", FLOAT),
                ("estado", TEXT),
            ),
            ("codigo_6d",),
            uniques=(("codigo_ibge",),),
        ),
        TableSpec("procedimentos", (("PROC_REA", LONG), ("NOME_PROC", TEXT)), ("PROC_REA",)),
        TableSpec(
            "hospital",
            (("CNES", LONG), ("NATUREZA", TEXT), ("GESTAO", TEXT), ("NAT_JUR", TEXT)),
            ("CNES",),
        ),
        TableSpec(
            "indicadores",
            (
                ("codigo_6d", LONG),
                ("ano", INT),
                ("metrica", TEXT),
                ("valor", DOUBLE),
                ("escala", TEXT),
            ),
            ("codigo_6d", "ano", "metrica"),
            (Reference("codigo_6d", "municipios", "codigo_6d"),),
        ),
        TableSpec(
            FACT,
            (
                ("CNES", LONG),
                (CASE, LONG),
                ("ESPEC", BYTE),
                ("IDENT", BYTE),
                ("DT_INTER", DATE),
                ("DT_SAIDA", DATE),
                ("DIAS_PERM", SHORT),
                ("VAL_SH", DOUBLE),
                ("VAL_SP", DOUBLE),
                ("VAL_TOT", DOUBLE),
                ("COMPLEX", BYTE),
                ("MUNIC_MOV", INT),
                ("DIAG_PRINC", TEXT),
                ("NASC", DATE),
                ("SEXO", BYTE),
                ("IDADE", SHORT),
                ("NACIONAL", SHORT),
                ("NUM_FILHOS", BYTE),
                ("RACA_COR", BYTE),
                ("MUNIC_RES", INT),
                ("CEP", LONG),
            ),
            (CASE,),
            (
                Reference("CNES", "hospital", "CNES"),
                Reference("MUNIC_RES", "municipios", "codigo_6d"),
                Reference("MUNIC_MOV", "municipios", "codigo_6d"),
                Reference("DIAG_PRINC", "cid10", "CID"),
            ),
        ),
        _satellite(
            "uti_detalhes",
            ("UTI_MES_TO", INT),
            ("MARCA_UTI", TEXT),
            ("UTI_INT_TO", INT),
            ("VAL_UTI", DOUBLE),
        ),
        _satellite("condicoes_especificas", ("IND_VDRL", TEXT)),
        _satellite("obstetricos", ("INSC_PN", TEXT)),
        _satellite("instrucao", ("INSTRU", BYTE)),
        _satellite(
            "mortes", ("CID_MORTE", TEXT), refs=(Reference("CID_MORTE", "cid10", "CID"),)
        ),
        _satellite("infehosp", ("INFEHOSP", TEXT)),
        _satellite("vincprev", ("VINCPREV", TEXT)),
        _satellite("cbor", ("CBOR", INT)),
        _satellite(
            "contraceptivos", ("TIPO", TEXT), ("CODIGO_METODO", TEXT), key=(CASE, "TIPO")
        ),
        _satellite("etnia", ("ETNIA", INT)),
        _satellite(
            "notificacoes", ("CID_NOTIF", TEXT), refs=(Reference("CID_NOTIF", "cid10", "CID"),)
        ),
        _satellite("pernoite", ("DIAR_ACOM", INT)),
        _satellite(
            "diagnosticos", ("DIAG_SECUN", TEXT), refs=(Reference("DIAG_SECUN", "cid10", "CID"),)
        ),
        TableSpec(
            "atendimentos",
            (("id_atendimento", LONG), (CASE, LONG), ("PROC_REA", LONG)),
            ("id_atendimento",),
            (TO_CASE, Reference("PROC_REA", "procedimentos", "PROC_REA")),
            generated_id="id_atendimento",
        ),
    )
}


def load_order(names: Iterable[str] | None = None) -> list[str]:
    """Referenced tables before the tables that refer to them."""
    wanted = list(names) if names is not None else list(TABLES)
    placed: list[str] = []

    def place(name: str) -> None:
        if name in placed:
            return
        for ref in TABLES[name].references:
            if ref.to_table in wanted and ref.to_table != name:
                place(ref.to_table)
        placed.append(name)

    for name in wanted:
        place(name)
    return placed


# Relational types by Spark type name.
RELATIONAL_TYPES = {
    "byte": "INTEGER",
    "short": "INTEGER",
    "integer": "INTEGER",
    "long": "BIGINT",
    "float": "DOUBLE PRECISION",
    "double": "DOUBLE PRECISION",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "string": "VARCHAR",
}


def relational_type(data_type: T.DataType, in_primary_key: bool = False) -> str:
    """Column type for a relational target; a long primary key numbers itself."""
    if in_primary_key and isinstance(data_type, T.LongType):
        return "BIGSERIAL"
    return RELATIONAL_TYPES.get(data_type.typeName(), "TEXT")


def relational_columns(spec: TableSpec) -> str:
    """Value of the JDBC writer's ``createTableColumnTypes`` option."""
    return ", ".join(
        f"{name} {relational_type(dtype, name in spec.primary_key)}"
        for name, dtype in spec.columns
    )
