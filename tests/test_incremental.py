"""Loads that come bit by bit: drifting files, standing contractions, snapshots of many tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardmill.operators.contract import contract
from wardmill.operators.standing import Contraction, StandingContraction
from wardmill.plans.records import COLUMNS, contract_records, record_contraction, treat
from wardmill.sinks import writers as W
from wardmill.sinks.snapshot import Conflict, Store
from wardmill.sources.files import discover, read_drifting
from wardmill.streaming import ingest as I


def one_file(spark, folder, name, schema, rows):
    folder.mkdir(parents=True, exist_ok=True)
    spark.createDataFrame(rows, schema).toPandas().to_parquet(folder / name, index=False)


def bag(df):
    return sorted(map(str, df.collect()))


def text_file(spark, raw):
    one_file(spark, raw, "a.parquet", "N_AIH string, VAL_SH string, DT_INTER string",
             [("1", "1,5", "20200102"), ("x", "2", None), ("2", "4", "20200101")])


def number_files(spark, raw):
    one_file(spark, raw / "2009", "b.parquet", "N_AIH bigint, VAL_SH double, EXTRA int", [(1, 2.25, 0), (3, 1e7, 1)])
    one_file(spark, raw, "c.parquet", "N_AIH double, PROC_REA bigint", [(2.0, 77)])
    (raw / "d.parquet").write_bytes(b"not parquet at all")


def forget_last_commit(checkpoint):
    """What a crash between the end of the last batch and its commit leaves."""
    names = [p for p in (Path(checkpoint) / "commits").iterdir() if p.name.isdigit()]
    last = max(names, key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)


def test_stream_of_drifting_files_equals_the_batch(spark, tmp_path):
    raw, out, checkpoint = (tmp_path / n for n in ("raw", "out", "cp"))
    text_file(spark, raw)
    I.treat_new_files(spark, str(raw), str(out), str(checkpoint)).awaitTermination()
    number_files(spark, raw)
    for _ in "ab":  # the second run finds nothing new
        I.treat_new_files(spark, str(raw), str(out), str(checkpoint), files_per_batch=2).awaitTermination()
    paths = [r.path for r in discover(spark, str(raw)).collect()]
    whole = treat(read_drifting(spark, paths, COLUMNS).rows)
    got = spark.read.parquet(str(out))
    assert bag(got.select(*whole.columns)) == bag(whole)
    left = I.left_out(spark, str(out)).collect()
    assert [Path(r.path).name for r in left] == ["d.parquet"]


def test_a_batch_given_again_adds_no_row(spark, tmp_path):
    raw, out, checkpoint = (tmp_path / n for n in ("raw", "out", "cp"))
    text_file(spark, raw)
    number_files(spark, raw)
    I.treat_new_files(spark, str(raw), str(out), str(checkpoint)).awaitTermination()
    before = bag(spark.read.parquet(str(out)))
    forget_last_commit(checkpoint)
    I.treat_new_files(spark, str(raw), str(out), str(checkpoint)).awaitTermination()
    assert bag(spark.read.parquet(str(out))) == before and len(before) == 6


def test_a_batch_that_fails_is_taken_whole_later(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "cp"))
    text_file(spark, tmp_path / "raw")

    def failing(rows):
        return treat(rows).withColumn("VAL_SH", F.raise_error(F.lit("lost")).cast("double"))

    query = I.ingest_new_files(spark, raw, out, checkpoint, transform=failing)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    I.treat_new_files(spark, raw, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_file_contents_are_not_read_by_the_stream(spark, tmp_path):
    text_file(spark, tmp_path / "raw")
    files = I.arriving_files(spark, str(tmp_path / "raw"))
    query = (
        files.writeStream.foreachBatch(lambda batch, number: batch.collect())
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    read = query._jsq.explainInternal(False).split("ReadSchema")
    assert len(read) > 1 and "content" not in read[-1]


SPEC = dict(key=("k",), sums=("amount",), means=("level",), order=("day",))
ROW = "k int, day int, amount decimal(10,2), level int, note string, doubled decimal(12,2)"


def recomputed(columns):
    return {"doubled": F.col("amount") * 2} if "doubled" in columns else {}


def rows_of(spark, *rows):
    return spark.createDataFrame([(*r, None) for r in rows], ROW)


@pytest.fixture
def loads(spark):
    from decimal import Decimal as D

    return [
        rows_of(spark, (1, 3, D("1.10"), 1, "c"), (2, 1, D("2.00"), None, "x"), (None, 1, D("9.00"), 4, None)),
        rows_of(spark, (1, 2, D("0.05"), 2, None), (3, 9, None, 5, "z"), (None, 0, D("1.00"), None, "n")),
        rows_of(spark, (1, 2, D("0.01"), 6, "a"), (1, 2, D("0.01"), 6, "a")),
    ]


def standing(spark, root, buckets=16):
    names = ["k", "day", "amount", "level", "note", "doubled"]
    spec = Contraction(columns=names, recomputed=recomputed, **SPEC)
    return StandingContraction(spark, str(root), spec, buckets)


def whole(loads):
    df = loads[0].union(loads[1]).union(loads[2])
    return contract(df, **SPEC, recomputed=recomputed(df.columns))


def test_three_loads_equal_one_contraction(spark, tmp_path, loads):
    kept = standing(spark, tmp_path / "s")
    touched = [kept.load(rows) for rows in loads]
    expected = whole(loads)
    result = kept.result()
    assert result.columns == expected.columns
    assert [tuple(map(str, r)) for r in result.orderBy("k").collect()] == [
        tuple(map(str, r)) for r in expected.orderBy("k").collect()
    ]
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    # the last load holds one key, so it rewrites one bucket and leaves the others' files
    assert len(touched[2]) == 1 and set(touched[2]) < set(touched[0])
    before, after = kept.store.read(2).parts, kept.store.read(3).parts
    assert {b for b in after if after[b] != before.get(b)} == {str(touched[2][0])}


def test_a_load_made_again_counts_once(spark, tmp_path, loads):
    kept = standing(spark, tmp_path / "s")
    for number, rows in enumerate(loads):
        assert kept.load(rows, number)
        assert kept.load(rows, number) == []
    assert bag(kept.result()) == bag(whole(loads).select(*kept.result().columns))
    assert kept.load(loads[0].limit(0), 3) == [] and kept.store.read().progress == {"rows": 3}


def test_a_load_that_fails_changes_nothing(spark, tmp_path, loads, monkeypatch):
    kept = standing(spark, tmp_path / "s")
    kept.load(loads[0], 0)
    before = bag(kept.result())

    def lost(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lost)
        with pytest.raises(OSError):
            kept.load(loads[1], 1)
    assert bag(kept.result()) == before
    kept.load(loads[1], 1)
    kept.load(loads[2], 2)
    assert bag(kept.result()) == bag(whole(loads).select(*kept.result().columns))


def test_records_contracted_from_a_stream(spark, tmp_path):
    raw, checkpoint = tmp_path / "raw", str(tmp_path / "cp")
    kept = StandingContraction(spark, str(tmp_path / "s"), record_contraction(), 8)
    text_file(spark, raw)
    I.contract_new_files(spark, str(raw), kept, checkpoint).awaitTermination()
    number_files(spark, raw)
    I.contract_new_files(spark, str(raw), kept, checkpoint, files_per_batch=1).awaitTermination()
    forget_last_commit(checkpoint)
    I.contract_new_files(spark, str(raw), kept, checkpoint).awaitTermination()
    paths = [r.path for r in discover(spark, str(raw)).collect()]
    expected = contract_records(treat(read_drifting(spark, paths, COLUMNS).rows))
    assert bag(kept.result()) == bag(expected.select(*kept.result().columns))
    assert expected.count() == 4


def star(spark, mark):
    return {
        "hospital": spark.createDataFrame([(1, mark)], "CNES bigint, NATUREZA string"),
        "cid10": spark.createDataFrame([("A09", mark)], "CID string, CD_DESCRICAO string"),
    }


def test_readers_see_the_old_tables_until_the_load_is_whole(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    assert store.tables() == {}
    assert W.load_snapshot(star(spark, "old"), store) == {"cid10": 1, "hospital": 1}
    seen = []
    plain = W.write_parquet

    def watched(df, path, mode="overwrite", by=()):
        """A reader while the load runs; the second table breaks off."""
        seen.append({name: t.first()[1] for name, t in store.tables().items()})
        if len(seen) == 2:
            raise OSError("lost")
        return plain(df, path, mode, by)

    with monkeypatch.context() as m:
        m.setattr(W, "write_parquet", watched)
        with pytest.raises(OSError):
            W.load_snapshot(star(spark, "new"), store)
    now = {name: t.select(t.columns[1]).first()[0] for name, t in store.tables().items()}
    assert now == {"cid10": "old", "hospital": "old"} and seen[0] == seen[1]
    W.load_snapshot(star(spark, "new"), store)
    assert {t.select(c).first()[0] for t in store.tables().values() for c in [t.columns[1]]} == {"new"}
    assert store.tables(1)["cid10"].first()[1] == "old"
    # an empty input keeps the table and its folder
    empty = {"cid10": star(spark, "x")["cid10"].limit(0), "hospital": star(spark, "third")["hospital"]}
    before = store.read().parts["cid10"]
    W.load_snapshot(empty, store)
    assert store.read().parts["cid10"] == before


def test_versions_conflict_and_expire(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    base = store.read()
    W.load_snapshot(star(spark, "a"), store)
    with pytest.raises(Conflict):
        store.commit(base, {"cid10": "elsewhere"})
    first = store.read().parts
    for mark in "bcd":
        W.load_snapshot(star(spark, mark), store)
    assert store.versions() == [1, 2, 3, 4] and store.expire(2) == 2
    assert store.versions() == [3, 4]
    assert not any((tmp_path / folder).exists() for folder in first.values())
    assert store.tables()["cid10"].count() == store.tables(3)["hospital"].count() == 1
