"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [sf] [name..]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata")
KINDS = {
    "byte": "int", "short": "int", "integer": "int", "long": "int",
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int",
    "HUGEINT": "huge", "decimal": "huge", "DECIMAL(38,0)": "huge", "float": "float", "double": "float", "FLOAT": "float", "DOUBLE": "float",
    "string": "text", "VARCHAR": "text", "date": "date", "DATE": "date",
    "boolean": "bool", "BOOLEAN": "bool", "timestamp_ntz": "time", "TIMESTAMP": "time",
}


def connect(sf_dir) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (Decimal, float)):
        return float(value) + 0.0
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def bag(rows, order) -> Counter:
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, query, sql) -> list[str]:
    """Differences in columns, kinds of types and rows; an empty list is agreement."""
    df = query(spark, str(sf_dir))
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    problems = []
    for field in df.schema:
        kind = KINDS.get(field.dataType.typeName(), field.dataType.typeName())
        if kind != kinds[field.name]:
            problems.append(f"type of {field.name}: {kind} != {kinds[field.name]}")
    common = sorted(names)
    ours = bag(df.collect(), [df.columns.index(c) for c in common])
    theirs = bag(result.fetchall(), [names.index(c) for c in common])
    if ours != theirs:
        only = list((ours - theirs).items())[:3]
        other = list((theirs - ours).items())[:3]
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}, columns {common}\n"
            f"   only spark: {only}\n   only sql:   {other}"
        )
    elif not ours:
        problems.append("empty result")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from wardmill.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = DATA / f"sf{sf}"
    con = connect(sf_dir)
    found, sqls = queries(), oracle_sql()
    failed = 0
    for name in sys.argv[2:] or found:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, found[name], sqls[name])
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("   ", problem)
    print(f"{failed} of {len(sys.argv[2:] or found)} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
