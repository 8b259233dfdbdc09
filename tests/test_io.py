from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardmill.operators.keys import orphan_keys
from wardmill.plans.model import TABLES
from wardmill.plans.records import COLUMNS
from wardmill.plans.workflow import Layout, audit_stage, run_all
from wardmill.session import drop_staged, shared_dir, stage
from wardmill.sinks import writers as W
from wardmill.sources import files as S
from wardmill.sources import manifest as M
from wardmill.sources.tables import known_values
from wardmill.streaming.ingest import treat_new_files


def one_file(df, folder: Path, name: str) -> None:
    """Write a single parquet file under a chosen name."""
    folder.mkdir(parents=True, exist_ok=True)
    df.toPandas().to_parquet(folder / name, index=False)


@pytest.fixture
def raw_folder(spark, tmp_path):
    """Months with different columns and types, a nested one, a folder named like a file, junk."""
    raw = tmp_path / "raw"
    one_file(
        spark.createDataFrame(
            [("1", 2000001, "x"), ("2", 2000002, "y")], "N_AIH string, CNES int, EXTRA string"
        ),
        raw,
        "RD0801.parquet",
    )
    one_file(
        spark.createDataFrame([("3", "2000003", "0012")], "N_AIH string, CNES string, ETNIA string"),
        raw / "2009",
        "RD0901.parquet",
    )
    one_file(
        spark.createDataFrame([("4", "2000004", "0012")], "N_AIH string, CNES string, ETNIA string"),
        raw / "RD0902.parquet",
        "part-0.parquet",
    )
    (raw / "RD0903.parquet").write_bytes(b"not parquet at all")
    return raw


def test_discover_lists_leaf_files_once(spark, raw_folder):
    found = [r.stem for r in S.discover(spark, str(raw_folder)).collect()]
    assert sorted(found) == ["RD0801", "RD0901", "RD0903", "part-0"]


def test_stems(values):
    rows = ["RDRS0801.dbc.parquet", "RDRS0801.dbc", "RDRS0801.parquet", "RDRS0801"]
    assert values(rows, "string", S.file_stem) == ["RDRS0801"] * 4


def test_read_drifting(spark, raw_folder):
    paths = [r.path for r in S.discover(spark, str(raw_folder)).collect()]
    ingest = S.read_drifting(spark, paths, COLUMNS)
    assert ingest.rows.columns == list(COLUMNS)
    assert {t for _, t in ingest.rows.dtypes} == {"string"}
    got = sorted((r.N_AIH, r.CNES, r.ETNIA) for r in ingest.rows.collect())
    assert got == [
        ("1", "2000001", None),
        ("2", "2000002", None),
        ("3", "2000003", "0012"),
        ("4", "2000004", "0012"),
    ]
    assert [Path(p).name for p in ingest.skipped] == ["RD0903.parquet"]
    with pytest.raises(FileNotFoundError):
        S.read_drifting(spark, ingest.skipped, COLUMNS)


def test_rows_per_file(spark, raw_folder):
    good = spark.read.parquet(str(raw_folder / "RD0801.parquet"), str(raw_folder / "RD0902.parquet"))
    counts = S.rows_per_file(good)
    assert sorted(r.rows for r in counts.collect()) == [1, 2]
    listed = S.discover(spark, str(raw_folder))
    left = S.unread_files(listed, counts)
    assert sorted(r.stem for r in left.collect()) == ["RD0901", "RD0903"]


def test_new_files(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    present = spark.createDataFrame([("a", 10), ("b", 0)], "stem string, length bigint")
    assert sorted(r.stem for r in M.new_files(listed, present).collect()) == ["b", "c"]


def test_expected_grid_and_gaps(spark):
    units = spark.createDataFrame([("RS",), ("SC",)], "uf string")
    grid = M.expected_grid(units, 2008, 2009, M.MONTHS)
    assert grid.count() == 2 * 2 * 12
    present = grid.where("NOT (uf = 'SC' AND month = 7)")
    gaps = M.coverage_gaps(grid, present.union(present), ("uf", "year", "month"))
    assert sorted(tuple(r) for r in gaps.collect()) == [("SC", 2008, 7), ("SC", 2009, 7)]


def test_lookups(spark, tmp_path):
    text = 'codigo_6d,codigo_ibge,nome,latitude,longitude,estado\n'
    text += '430010,4300109,"Água Santa, RS",-28.1,-52.0,RS\n'
    (tmp_path / "municipios.csv").write_bytes(text.encode("latin-1"))
    schemas = {n: TABLES[n].schema for n in ("municipios", "cid10")}
    sources = {n: f"{tmp_path}/{n}.csv" for n in schemas}
    out = f"{tmp_path}/out"
    assert S.convert_lookups(spark, sources, schemas, out) == {
        "municipios": "converted",
        "cid10": "missing",
    }
    row = spark.read.parquet(f"{out}/municipios").first()
    assert (row.codigo_6d, row.nome) == (430010, "Água Santa, RS")
    assert S.convert_lookups(spark, sources, schemas, out)["municipios"] == "present"


def test_known_values_prunes_and_pushes(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1, "a"), (None, "b")], "p int, q string").write.parquet(path)
    df = known_values(spark.read.parquet(path), "p")
    plan = df._jdf.queryExecution().toString()
    assert "IsNotNull(p)" in plan and "ReadSchema: struct<p:int>" in plan
    assert [r.p for r in df.collect()] == [1]


def test_write_parquet_counts_rows(spark, tmp_path):
    df = spark.range(100).withColumn("year", F.col("id") % 2)
    assert W.write_parquet(df, f"{tmp_path}/t", by=("year",)) == 100
    assert spark.read.parquet(f"{tmp_path}/t").where("year = 1").count() == 50


def test_write_csv(spark, tmp_path):
    W.write_csv(spark.createDataFrame([(1, "a,b")], "x int, y string"), f"{tmp_path}/c", True)
    files = list(Path(f"{tmp_path}/c").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text() == 'x,y\n1,"a,b"\n'


def test_versions(spark, tmp_path):
    path = f"{tmp_path}/v"
    assert W.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        W.read_version(spark, path)
    first = W.write_version(spark.range(3), path)
    W.write_version(spark.range(5), path)
    assert W.read_version(spark, path).count() == 5
    assert W.read_version(spark, path, first).count() == 3
    # A version whose pointer was never written does not exist for readers.
    W.write_parquet(spark.range(9), f"{path}/version=99991231_000000_000000")
    assert W.read_version(spark, path).count() == 5


def test_load_all_skips_empty_and_numbers_rows(spark, tmp_path):
    tables = {
        "atendimentos": spark.createDataFrame([(2, 7), (1, 7), (1, 7)], "N_AIH int, PROC_REA int"),
        "cid10": spark.createDataFrame([], "CID string"),
        "pernoite": spark.createDataFrame([(1, 2.5, 0)], "N_AIH int, DIAR_ACOM double, extra int"),
    }
    loaded = W.load_all(tables, W.parquet_writer(str(tmp_path)))
    assert loaded == {"atendimentos": 3, "pernoite": 1}
    rows = spark.read.parquet(f"{tmp_path}/atendimentos").orderBy("id_atendimento").collect()
    assert [r.id_atendimento for r in rows] == [1, 2, 3]
    assert sorted((r.N_AIH, r.PROC_REA) for r in rows) == [(1, 7), (1, 7), (2, 7)]
    assert tuple(spark.read.parquet(f"{tmp_path}/pernoite").first()) == (1, 2)


def test_catalog_writer(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ward")
    write = W.catalog_writer("ward")
    df = spark.createDataFrame([("A09", "x")], "CID string, CD_DESCRICAO string")
    assert W.load_all({"cid10": df}, write) == {"cid10": 1}
    assert W.load_all({"cid10": df.union(df)}, write) == {"cid10": 2}
    assert spark.table("ward.cid10").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ward")
    fact = spark.range(50).select(F.col("id").alias("N_AIH"))
    tables = {"internacoes": fact, "cbor": fact.select("N_AIH", F.lit(5).alias("CBOR"))}
    assert W.load_all(tables, W.catalog_writer("ward", buckets=4)) == {
        "internacoes": 50,
        "cbor": 50,
    }
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orphans = orphan_keys(
            spark.table("ward.cbor"), "N_AIH", spark.table("ward.internacoes"), "N_AIH"
        )
        plan = orphans._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert orphans.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_row_totals(spark):
    counts = W.with_total(W.table_rows({"a": spark.range(3), "b": spark.range(4)}))
    assert {r.table_name: r.rows for r in counts.collect()} == {"a": 3, "b": 4, "total": 7}


def test_stage_and_shared_dir(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert stage(spark.range(5), "t").count() == 5


def test_stream_reads_each_file_once(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "cp"))
    first = spark.createDataFrame([("1", "1,5"), ("x", "2")], "N_AIH string, VAL_SH string")
    one_file(first, Path(raw), "a.parquet")
    treat_new_files(spark, raw, out, checkpoint).awaitTermination()
    assert sorted((r.N_AIH, r.VAL_SH) for r in spark.read.parquet(out).collect()) == [
        (0, 2.0),
        (1, 1.5),
    ]
    one_file(spark.createDataFrame([("7", "3")], "N_AIH string, VAL_SH string"), Path(raw), "b.parquet")
    treat_new_files(spark, raw, out, checkpoint, files_per_batch=1).awaitTermination()
    treat_new_files(spark, raw, out, checkpoint).awaitTermination()
    assert sorted(r.N_AIH for r in spark.read.parquet(out).collect()) == [0, 1, 7]


def test_whole_run(spark, tmp_path):
    at = Layout(str(tmp_path))
    columns = "N_AIH string, CNES string, PROC_REA string, DT_INTER string, DT_SAIDA string, "
    columns += "NASC string, VAL_SH string, DIAG_PRINC string, MUNIC_RES string, SEXO string, "
    columns += "RACA_COR string, MORTE string, CID_MORTE string"
    rows = [
        ("1", "10", "5", "20200101", "20200103", "19800101", "10,5", "a09", "430010", "1", "01",
         "1", "I21"),
        ("1", "10", "6", "20200101", "20200103", "19800101", "1", "a09", "430010", "1", "01", "0",
         "0"),
        ("2", "11", "5", "20200105", "20200103", "20300101", "2", "zz", "990000", "7", "01", "0",
         "0"),
    ]
    one_file(spark.createDataFrame(rows, columns), Path(at.raw), "RD2001.parquet")
    Path(at.support).mkdir()
    (Path(at.support) / "cid10.csv").write_text("CID,CD_DESCRICAO\nA09,x\nI21,y\n")
    (Path(at.support) / "procedimentos.csv").write_text("PROC_REA,NOME_PROC\n5,a\n6,b\n")
    header = "codigo_6d,codigo_ibge,nome,latitude,longitude,estado\n"
    (Path(at.support) / "municipios.csv").write_text(header + "430010,4300109,T,1,2,RS\n0,0,?,0,0,?\n")
    out = run_all(spark, at)
    assert out["unify"] == {"rows": 3, "files": 1, "skipped": []}
    assert out["contract"] == 2
    assert out["split"]["atendimentos"] == 3
    assert out["load"]["internacoes"] == 2
    failing = {
        (r.check_name, r.table_name, r.column_name): r.violations
        for r in audit_stage(spark, at).where("NOT passed AND reason IS NULL").collect()
    }
    absent = audit_stage(spark, at).where("reason IS NOT NULL").collect()
    assert {r.reason for r in absent} and not any(r.passed for r in absent)
    assert spark.read.parquet(f"{at.reports}/unidentified").count() == 0
    shared = Path(shared_dir(spark).removeprefix("file:"))
    assert not (shared / f"wardmill-{spark.sparkContext.applicationId}").exists()
    # The second case is broken on purpose; each of its faults is found by its own check.
    assert failing == {
        ("accepted_values", "internacoes", "SEXO"): 1,
        ("date_order", "internacoes", "DT_INTER..DT_SAIDA"): 1,
        # Born after admission, so the age is 0, which the written contract does not allow.
        ("positive", "internacoes", "IDADE"): 1,
        ("format", "internacoes", "DIAG_PRINC"): 1,
        ("relationships", "internacoes", "DIAG_PRINC"): 1,
        ("relationships", "internacoes", "MUNIC_RES"): 1,
        ("foreign_key", "internacoes", "DIAG_PRINC"): 1,
        ("foreign_key", "internacoes", "MUNIC_RES"): 1,
    }
    run_all(spark, at)
    assert len(W.versions(spark, at.treated)) == 2


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    """Footers are read by tasks: 40 and 200 files take the same number of jobs."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        folder = tmp_path / f"files{n}"
        folder.mkdir()
        table = pa.table({"N_AIH": ["1"], "CNES": ["2"]})
        for i in range(n):
            pq.write_table(table, folder / f"f{i}.parquet")
        group = f"files{n}"
        spark.sparkContext.setJobGroup(group, group)
        ingest = S.read_drifting(spark, [f"file:{p}" for p in sorted(folder.iterdir())], COLUMNS)
        used = len(tracker.getJobIdsForGroup(group))
        assert ingest.rows.count() == n
        return used

    assert jobs(40) == jobs(200)


def test_only_broken_footers_are_skipped(spark, tmp_path):
    good, broken = tmp_path / "good.parquet", tmp_path / "broken.parquet"
    pq.write_table(pa.table({"N_AIH": ["1"]}), good)
    broken.write_bytes(b"PAR1 but no footer")
    ingest = S.read_drifting(spark, [f"file:{good}", f"file:{broken}"], COLUMNS)
    assert ingest.skipped == [f"file:{broken}"] and ingest.rows.count() == 1
    with pytest.raises(Exception, match="absent"):
        S.read_drifting(spark, [f"file:{good}", f"file:{tmp_path}/absent.parquet"], COLUMNS)


def test_a_replaced_parent_empties_its_children(spark, tmp_path):
    write, spec = W.parquet_writer(str(tmp_path)), TABLES
    fact = spark.createDataFrame([(1,)], "N_AIH long")
    cbor = spark.createDataFrame([(1,)], "N_AIH long")
    assert W.load_all({"internacoes": fact, "cbor": cbor}, write) == {"internacoes": 1, "cbor": 1}
    loaded = W.load_all({"internacoes": fact.selectExpr("N_AIH + 1 AS N_AIH"), "cbor": cbor.limit(0)}, write)
    assert loaded == {"internacoes": 1, "cbor": 0}
    assert spark.read.schema(spec["cbor"].schema).parquet(f"{tmp_path}/cbor").count() == 0


def test_buckets_are_files(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    fact = spark.range(1000).selectExpr("id AS N_AIH").repartition(8)
    W.catalog_writer("bucketed", buckets=4)("internacoes", fact)
    assert spark.table("bucketed.internacoes").select("_metadata.file_path").distinct().count() == 4


def test_staged_tables_can_be_dropped(spark):
    kept = stage(spark.range(3), "kept")
    assert kept.count() == 3
    drop_staged(spark)
    folder = Path(shared_dir(spark).removeprefix("file:")) / f"wardmill-{spark.sparkContext.applicationId}"
    assert not folder.exists()
