"""Table writes and reads, the whole jobs, and the command line."""

import csv
import glob
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from wardflow import jobs, schemas, session
from wardflow.functions.constants import METRIC_NAMES
from wardflow.operators import ingest, summary as sm
from wardflow.plans.daily import load_incremental_summary, run_daily_summary, run_incremental_summary
from wardflow.plans.risk_refresh import run_risk_refresh
from wardflow.sources import log, tables
from wardflow.streaming.ingest import write_micro_batch
from tests.test_operators import AS_OF, at, profiles, vitals


@pytest.fixture
def stored_vitals(spark, tmp_path):
    path = str(tmp_path / "vitals")
    rows = [("a", at(0), "spo2", 97.0), ("b", at(-5), "spo2", 91.0), ("a", at(days=-1), "spo2", 95.0)]
    vitals(spark, rows).write.parquet(path)
    return path


def test_daily_summary_can_be_run_again(spark, stored_vitals, tmp_path):
    target = str(tmp_path / "summary")
    assert run_daily_summary(spark, stored_vitals, target, "2024-01-01")
    assert run_daily_summary(spark, stored_vitals, target, "2024-01-02")
    assert run_daily_summary(spark, stored_vitals, target, "2024-01-02")
    rows = tables.load_daily_summary(spark, target)
    assert sorted((str(r.stat_date), r.avg_value, r.patient_count) for r in rows.collect()) == [("2024-01-01", 95.0, 1), ("2024-01-02", 94.0, 2)]
    plan = sm.read_daily_summary(rows, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan


def test_an_empty_day_writes_nothing(spark, stored_vitals, tmp_path):
    target = str(tmp_path / "summary")
    assert not run_daily_summary(spark, stored_vitals, target, "2020-01-01")
    assert tables.load_daily_summary(spark, target).count() == 0
    run_daily_summary(spark, stored_vitals, target, "2024-01-02")
    tables.write_daily_summary(sm.daily_summary(tables.load_vitals(spark, stored_vitals), "2020-01-01"), target)
    assert tables.load_daily_summary(spark, target).count() == 1


def test_a_missing_table_is_an_error_unless_said_otherwise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.load_vitals(spark, str(tmp_path / "nothing"))
    assert tables.load_vitals(spark, str(tmp_path / "nothing"), missing_ok=True).count() == 0
    assert tables.load_alerts(spark, str(tmp_path / "nothing")).count() == 0
    with pytest.raises(Exception):
        tables.load_table(spark, str(tmp_path), "a int", fmt="no_such_format")


def test_vitals_in_another_format(spark, stored_vitals, tmp_path):
    path = str(tmp_path / "orc")
    tables.load_vitals(spark, stored_vitals).write.orc(path)
    assert sorted(tables.load_vitals(spark, path, "orc").collect()) == sorted(tables.load_vitals(spark, stored_vitals).collect())


def test_profiles_full_refresh(spark, tmp_path):
    path = str(tmp_path / "profiles")
    tables.refresh_profiles(profiles(spark, ("a", 0.1), ("b", 0.2)), path)
    tables.refresh_profiles(profiles(spark, ("c", 0.3)), path)
    assert [r.patient_id for r in tables.load_profiles(spark, path).collect()] == ["c"]


def test_risk_refresh_in_place(spark, tmp_path):
    people, root, readings = str(tmp_path / "profiles"), str(tmp_path / "root"), str(tmp_path / "vitals")
    tables.refresh_profiles(profiles(spark, ("a", 0.0), ("b", 0.7), ("c", None)), people)
    vitals(spark, [("a", at(0), "heart_rate", 100.0), ("c", at(0), "heart_rate", 80.0)]).write.parquet(readings)
    assert run_risk_refresh(spark, people, readings, root, AS_OF) == 2
    got = {r.patient_id: r for r in tables.load_profiles(spark, people).collect()}
    assert got["a"].risk_score == pytest.approx(0.2) and got["a"].risk_score_source == "auto_vitals_v1"
    assert got["a"].risk_score_updated_at == AS_OF and got["a"].contact_info.email == "e"
    assert (got["b"].risk_score, got["b"].risk_score_updated_at) == (0.7, None)
    assert got["c"].risk_score == 0.0
    # a second run finds nothing to change and writes nothing, at the same time or later
    later = AS_OF + timedelta(seconds=1)
    for moment in (AS_OF, later):
        assert run_risk_refresh(spark, people, readings, root, moment) == 0
    assert len(glob.glob(f"{people}/{tables.SNAPSHOT}=*")) == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_risk_refresh(spark, people, f"{readings}-mistyped", root, AS_OF)


def test_refresh_with_nobody_empties_the_table(spark, tmp_path):
    people = str(tmp_path / "profiles")
    tables.refresh_profiles(profiles(spark, ("a", 0.0)), people)
    tables.refresh_profiles(profiles(spark, ("a", 0.0)).limit(0), people)
    assert tables.load_profiles(spark, people).count() == 0


def test_ranking_export(spark, tmp_path):
    path = str(tmp_path / "ranking")
    df = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 0)], "patient_id string, predicted_risk double, actual_high_risk int")
    tables.export_ranking(df.coalesce(1), path)
    (part,) = glob.glob(f"{path}/*.csv")
    with open(part) as file:
        assert list(csv.reader(file)) == [["patient_id", "predicted_risk", "actual_high_risk"], ["a", "0.9", "1"], ["b", "0.1", "0"]]


def test_shared_dir_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.new_work_dir(spark, "x").startswith(f"{named}/x-")
    session.ensure_checkpoint_dir(spark)
    assert named in spark.sparkContext.getCheckpointDir()


def test_command_line(spark, stored_vitals, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    target, people = str(tmp_path / "summary"), str(tmp_path / "profiles")
    jobs.main(["daily-summary", "--stat-date", "2024-01-02", "--source", stored_vitals, "--target", target])
    assert "Wrote the summary of 2024-01-02" in capsys.readouterr().out
    jobs.main(["daily-summary", "--stat-date", "2020-01-02", "--source", stored_vitals, "--target", target])
    assert "Nothing written" in capsys.readouterr().out
    with pytest.raises(ValueError):
        jobs.main(["daily-summary", "--stat-date", "tomorrow", "--source", stored_vitals, "--target", target])
    tables.refresh_profiles(profiles(spark, ("a", 0.9)), people)
    jobs.main(["risk-refresh", "--profiles", people, "--vitals", stored_vitals, "--alerts-root", str(tmp_path / "none"), "--as-of", "2024-01-02 12:00:00"])
    assert "Updated 1 profiles" in capsys.readouterr().out
    args = jobs.parse_args(["ingest", "--root", "r", "--option", "subscribe=other"])
    assert not args.available_now
    assert args.format == "kafka" and jobs._pairs(args.option) == {"subscribe": "other"}


def test_command_line_from_messages_to_ranking(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "get_session", lambda name: spark)
    root, feed, people = str(tmp_path / "root"), str(tmp_path / "feed"), str(tmp_path / "profiles")
    rng = random.Random(2)
    rows = [(f"p{i:02d}", at(-j), m, 80.0 + i + rng.random()) for i in range(40) for j, m in enumerate(METRIC_NAMES)]
    readings = vitals(spark, rows).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    readings.select(F.to_json(F.struct("*")).cast("binary").alias("value")).coalesce(1).write.parquet(feed)
    jobs.main(["ingest", "--root", root, "--format", "parquet", "--path", feed, "--available-now"])
    jobs.main(["compact", "--root", root, "2024-01-02"])
    clean = f"{root}/{tables.VITALS_CLEAN}"
    assert tables.load_vitals(spark, clean).count() == 240
    tables.refresh_profiles(profiles(spark, *[(f"p{i:02d}", None) for i in range(40)]), people)
    output = str(tmp_path / "ranking")
    jobs.main(["risk-model", "--profiles", people, "--vitals", clean, "--output", output, "--as-of", "2024-01-02 12:00:00"])
    ranking = spark.read.option("header", True).csv(output)
    assert ranking.count() == 40 and ranking.columns == ["patient_id", "predicted_risk", "actual_high_risk"]


def test_incremental_summary_equals_the_full_one(spark, tmp_path):
    root, state = str(tmp_path / "root"), str(tmp_path / "state")
    path = f"{root}/{tables.VITALS}"

    def send(batch, *rows):
        messages = vitals(spark, list(rows)).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        envelopes = messages.select(F.to_json(F.struct("*")).alias("value"))
        write_micro_batch(ingest.decode_vitals(envelopes, raw_as="raw_message"), batch, root)

    def rows_of(summary):
        return sorted((str(r.stat_date), r.metric_name, r.avg_value, r.min_value, r.max_value, r.patient_count) for r in summary.collect())

    def same():
        full = sm.daily_summary(tables.load_vitals(spark, path))
        assert rows_of(load_incremental_summary(spark, state)) == rows_of(full)

    send(0, ("a", at(0), "spo2", 97.0), ("b", at(0), "spo2", None))
    assert run_incremental_summary(spark, path, state) == 1
    same()
    send(1, ("a", at(-9), "spo2", 91.0), ("c", at(days=-1), "spo2", 95.0))
    send(2, ("c", at(days=-1, seconds=-5), "spo2", 93.0))
    untouched = {p.folder for p in log.state(spark, state).parts}
    assert run_incremental_summary(spark, path, state) == 2
    same()
    assert not untouched & {p.folder for p in log.state(spark, state).parts}
    # a day without news stays in its folder, and nothing new means no commit
    send(3, ("d", at(days=-1), "heart_rate", 70.0))
    today = {p.folder for p in log.state(spark, state).parts if p.folder.endswith("2024-01-02")}
    assert run_incremental_summary(spark, path, state) == 1
    assert today <= {p.folder for p in log.state(spark, state).parts}
    same()
    version = log.state(spark, state).version
    assert run_incremental_summary(spark, path, state) == 0 and log.state(spark, state).version == version
    # only the new folders are read
    log.compact(spark, path, schemas.RAW_VITALS, lambda df: df, "day", fan=4)
    send(4, ("e", at(0), "spo2", 99.0))
    assert [p.last for p in log.state(spark, path).parts] == [3, 4]
    assert run_incremental_summary(spark, path, state) == 1
    same()
