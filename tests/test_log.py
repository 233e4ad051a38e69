"""Tables with manifests: what readers see during commits, replays, compaction and refreshes."""

import glob

import pytest
from pyspark.sql import functions as F

from wardflow import schemas
from wardflow.operators import ingest
from wardflow.plans import risk_refresh
from wardflow.sources import log, tables
from wardflow.streaming.ingest import compact_batches, write_micro_batch
from tests.test_operators import at, profiles, vitals
from tests.test_streaming import message

SCHEMA = "k string, v int"


def rows_of(spark, path):
    found = log.load(spark, path, _schema(spark))
    return sorted((r.k, r.v) for r in found.collect())


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_appends_and_replayed_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    assert log.load(spark, path, _schema(spark)) is None and log.state(spark, path).version == 0
    log.append(frame(spark, ("a", 1)), path, batch=0, stream="s")
    log.append(frame(spark, ("a", 1)), path, batch=0, stream="s")
    log.append(frame(spark), path, batch=1, stream="s")
    log.append(frame(spark, ("b", 2)), path, batch=2, stream="s")
    assert rows_of(spark, path) == [("a", 1), ("b", 2)]
    # another stream counts its batches anew
    log.append(frame(spark, ("c", 3)), path, batch=0, stream="other")
    assert rows_of(spark, path) == [("a", 1), ("b", 2), ("c", 3)]
    log.append(frame(spark), path)
    assert log.state(spark, path).version == 4


def test_a_second_writer_fails_instead_of_overwriting(spark, tmp_path):
    path = str(tmp_path / "t")
    before = log.state(spark, path)
    log.overwrite(frame(spark, ("a", 1)), path, before)
    with pytest.raises(log.Conflict):
        log.overwrite(frame(spark, ("z", 9)), path, before)
    assert rows_of(spark, path) == [("a", 1)]
    # appends start again from what is there
    log.append(frame(spark, ("b", 2)), path)
    assert rows_of(spark, path) == [("a", 1), ("b", 2)]
    log.overwrite(frame(spark), path, log.state(spark, path))
    assert rows_of(spark, path) == []


def test_a_hundred_batches_fold_into_a_few_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(100):
        log.append(frame(spark, (f"k{i % 7}", i)).coalesce(1), path, "k", batch=i)
    everything = rows_of(spark, path)
    assert len(log.state(spark, path).parts) == 100 and len(everything) == 100
    reading = log.load(spark, path, _schema(spark))
    # 100 folders of a batch become one of them all: a hundred are taken in one fold
    assert log.compact(spark, path, _schema(spark), lambda df: df.coalesce(1), "k", fan=10) == 1
    found = log.state(spark, path)
    assert len(found.parts) == 1 and found.batch == 99
    assert rows_of(spark, path) == everything
    assert sorted((r.k, r.v) for r in reading.collect()) == everything  # planned before, read after
    assert len(glob.glob(f"{path}/commit=*")) == 101
    assert log.retire(spark, path, keep=1) == 100
    assert len(glob.glob(f"{path}/commit=*")) == 1 and rows_of(spark, path) == everything
    log.append(frame(spark, ("k0", 1)), path, "k", batch=99)  # a replay of what was folded
    assert rows_of(spark, path) == everything


def test_levels_and_appends_during_a_fold(spark, tmp_path):
    path = str(tmp_path / "t")
    sizes = []
    for i in range(18):
        log.append(frame(spark, ("a", i)), path, batch=i)
        log.compact(spark, path, _schema(spark), lambda df: df.coalesce(1), fan=3)
        sizes.append(len(log.state(spark, path).parts))
    assert max(sizes) <= 6 and sorted(p.level for p in log.state(spark, path).parts) == [2, 2]
    assert rows_of(spark, path) == [("a", i) for i in range(18)]

    def meanwhile(df):
        log.append(frame(spark, ("new", 1)), path)
        return df

    log.append(frame(spark, ("b", 0)), path)
    assert log.compact(spark, path, _schema(spark), meanwhile, fan=2) >= 1
    assert rows_of(spark, path)[18:19] == [("b", 0)] and ("new", 1) in rows_of(spark, path)

    def replaced(df):
        log.overwrite(frame(spark, ("all", 0)), path, log.state(spark, path))
        return df

    log.append(frame(spark, ("b", 1)), path)
    with pytest.raises(log.Conflict):
        log.compact(spark, path, _schema(spark), replaced, fan=2)
    assert rows_of(spark, path) == [("all", 0)]


def test_stream_tables_are_compacted(spark, tmp_path):
    root = str(tmp_path / "root")
    for i in range(12):
        texts = [message(f"p{i % 3}", i // 6, 121.0 + i), message("q", i, 80.0), "broken"]
        batch = ingest.decode_vitals(spark.createDataFrame([(t,) for t in texts], "value string"), raw_as="raw_message")
        write_micro_batch(batch, i, root)
    before = {r.patient_id: r.value for r in ingest.current_rows(tables.load_vitals(spark, f"{root}/{tables.VITALS}")).collect()}
    assert tables.load_vitals(spark, f"{root}/{tables.VITALS}").count() == 24
    assert compact_batches(spark, root, fan=4, keep=1) == dict.fromkeys(
        (tables.VITALS, tables.ALERTS, tables.ALERTS_BY_DAY, tables.ALERTS_BY_PATIENT, tables.QUARANTINE), 1
    )
    stored = tables.load_vitals(spark, f"{root}/{tables.VITALS}")
    assert stored.count() == 18  # p0 to p2 at two times, q at twelve
    assert {r.patient_id: r.value for r in ingest.current_rows(stored).collect()} == before
    for load in (tables.load_alerts, tables.load_alerts_by_day, tables.load_alerts_by_patient):
        assert load(spark, root).count() == 6
    assert tables.load_alerts_by_patient(spark, root, "p1").count() == 2
    assert tables.load_quarantine(spark, root).count() == 12
    assert len(glob.glob(f"{root}/{tables.ALERTS}/commit=*")) == 1
    files = glob.glob(f"{root}/{tables.ALERTS_BY_DAY}/commit=*/day=*/*.parquet")
    assert len(files) <= 2


def test_a_refresh_derived_from_the_table_itself_may_empty_it(spark, tmp_path):
    path = str(tmp_path / "profiles")
    tables.refresh_profiles(profiles(spark, ("a", 0.1), ("b", 0.2)), path)
    tables.refresh_profiles(tables.load_profiles(spark, path).filter("patient_id = 'nobody'"), path)
    assert tables.load_profiles(spark, path).count() == 0
    assert tables.load_profiles(spark, path).schema == schemas.PATIENT_PROFILES
    tables.refresh_profiles(profiles(spark, ("c", None)), path)
    assert [r.patient_id for r in tables.load_profiles(spark, path).collect()] == ["c"]
    assert len(glob.glob(f"{path}/{tables.SNAPSHOT}=*")) == 2  # the old ones wait for retirement
    assert log.retire(spark, path, keep=1) == 1


def test_of_two_refreshes_one_fails(spark, tmp_path, monkeypatch):
    people, readings = str(tmp_path / "profiles"), str(tmp_path / "vitals")
    tables.refresh_profiles(profiles(spark, ("a", 0.0)), people)
    vitals(spark, [("a", at(0), "heart_rate", 150.0)]).write.parquet(readings)
    real = risk_refresh.apply_patches

    def slow(table, patches):
        tables.refresh_profiles(profiles(spark, ("a", 0.9), ("new", None)), people)  # an edit comes between
        return real(table, patches)

    monkeypatch.setattr(risk_refresh, "apply_patches", slow)
    with pytest.raises(log.Conflict):
        risk_refresh.run_risk_refresh(spark, people, readings, str(tmp_path / "none"), at(0))
    assert {r.patient_id: r.risk_score for r in tables.load_profiles(spark, people).collect()} == {"a": 0.9, "new": None}


def test_partition_columns_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        log.append(spark.range(20).select(F.concat(F.lit("k"), F.col("id") % 4).alias("k"), F.col("id").cast("int").alias("v")), path, "k")
    found = log.load(spark, path, _schema(spark))
    assert set(found.columns) == {"k", "v"} and found.filter("k = 'k1'").count() == 15
    assert "PartitionFilters: [isnotnull(k" in found.filter("k = 'k1'")._jdf.queryExecution().executedPlan().toString()
