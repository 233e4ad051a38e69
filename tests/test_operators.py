"""Operators on literal rows: limits, cutoffs, ties, nulls, hot patients."""

import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wardflow.functions import constants as c
from wardflow.operators import alerts as al, features as ft, ingest, profiles as pr, risk as rk, summary as sm
from wardflow.operators import vitals as vt
from wardflow.operators.ranking import exact_cut, exact_median, top_n

AS_OF = datetime(2024, 1, 2, 12, 0, 0)
VITALS = "patient_id string, timestamp timestamp, metric_name string, value double, unit string"
ALERTS = (
    "alert_id string, patient_id string, metric_name string, observed_value double, alert_type string, "
    "timestamp timestamp, status string, day date"
)
PROFILES = (
    "patient_id string, name string, contact_info struct<email:string,phone:string>, medical_notes string, "
    "risk_score double, last_updated timestamp, risk_score_updated_at timestamp, risk_score_source string"
)


def at(seconds=0, **delta):
    return (AS_OF + timedelta(seconds=seconds, **delta)).replace(tzinfo=timezone.utc)


def vitals(spark, rows):
    return spark.createDataFrame([(p, t, m, v, "u") for p, t, m, v in rows], VITALS)


def alerts(spark, rows):
    return spark.createDataFrame(
        [(i, p, "heart_rate", v, "TACHYCARDIA", t, s, t.date()) for i, p, v, t, s in rows], ALERTS
    )


def profiles(spark, *rows):
    filled = [(p, f"name {p}", ("e", "f"), "notes", score, at(days=-9), None, None) for p, score in rows]
    return spark.createDataFrame(filled, PROFILES)


# Time filters


def test_lookback_keeps_the_cutoff_and_the_future(spark):
    rows = vitals(spark, [("a", at(minutes=-30), "spo2", 1.0), ("a", at(-1801), "spo2", 2.0), ("a", at(60), "spo2", 3.0)])
    assert sorted(r.value for r in vt.since(rows, AS_OF, 30).collect()) == [1.0, 3.0]
    assert [r.value for r in vt.since(rows, AS_OF, 30, upper_bound=True).collect()] == [1.0]
    # at least one minute, and as far back as asked
    assert vt.since(rows, AS_OF, 0).count() == 1
    old = vitals(spark, [("a", at(days=-1), "spo2", 1.0), ("a", at(-86401), "spo2", 2.0)])
    assert vt.since(old, AS_OF, 10**6).count() == 2


def test_for_day_is_half_open(spark):
    rows = vitals(spark, [("a", at(-12 * 3600), "spo2", 1.0), ("a", at(12 * 3600 - 1), "spo2", 2.0), ("a", at(12 * 3600), "spo2", 3.0)])
    assert sorted(r.value for r in vt.for_day(rows, "2024-01-02").collect()) == [1.0, 2.0]


# Newest N


def test_newest_vitals_ties_follow_the_metric_name(spark):
    rows = vitals(spark, [("a", at(0), m, 1.0) for m in ("spo2", "bp_systolic", "heart_rate")] + [("a", at(-1), "a", 0.0)])
    assert sorted(r.metric_name for r in vt.newest_vitals(rows, 2).collect()) == ["bp_systolic", "heart_rate"]
    one = vt.newest_vitals(rows, 2, patient_id="a").collect()
    assert [r.metric_name for r in one] == ["bp_systolic", "heart_rate"]
    assert vt.newest_vitals(rows, 0).count() == 1
    assert vt.newest_vitals(rows, 2, patient_id="nobody").count() == 0


@pytest.mark.parametrize("splits", [1, 3, 32])
def test_newest_vitals_of_a_hot_patient(spark, splits):
    rows = [("hot", at(-i), "spo2", float(i)) for i in range(1500)] + [(f"p{i % 50}", at(-i), "spo2", float(i)) for i in range(700)]
    random.Random(1).shuffle(rows)
    df = vitals(spark, rows).repartition(7)
    got = defaultdict(list)
    for r in vt.newest_vitals(df, 10_000, splits=splits).collect():
        got[r.patient_id].append(r.value)
    assert sorted(got["hot"]) == [float(i) for i in range(1500)]
    assert sum(map(len, got.values())) == 1500 + 700
    assert vt.newest_vitals(df, 600, splits=splits).filter("patient_id = 'hot'").count() == 600
    assert vt.newest_vitals(df, None, splits=splits).count() == 1500 + 700
    # a request for one patient is brought into its span
    assert vt.newest_vitals(df, 10_000, patient_id="hot").count() == 500


def test_history_has_every_page(spark):
    df = vitals(spark, [("p", at(-i), "spo2", float(i)) for i in range(700)])
    for one in ({}, {"patient_id": "p", "metric_name": "spo2"}):
        pages = [[r.value for r in vt.metric_history(df, 200, offset=o, **one).collect()] for o in (0, 400, 500, 600)]
        assert [len(p) for p in pages] == [200, 200, 200, 100]
        assert sorted(pages[3]) == [float(i) for i in range(600, 700)]


def test_features_reach_back_as_far_as_asked(spark):
    rows = vitals(spark, [("a", at(-36 * 3600), "spo2", 95.0), ("b", at(0), "lactate", 2.0)])
    assert ft.patient_features(rows, AS_OF, hours=72).count() == 2
    found = ft.patient_features(rows, AS_OF)
    assert found.columns == ["patient_id", "lactate"] and ft.label_column(found) == "lactate"


def test_the_last_arrival_of_a_batch_is_current(spark):
    key = ["p", at(0), "heart_rate"]
    rows = [(*key, 150.0, "bpm", 3, 7), (*key, 80.0, "bpm", 3, 9), (*key, 200.0, "bpm", 2, 50)]
    raw = spark.createDataFrame(rows, "patient_id string, timestamp timestamp, metric_name string, value double, unit string, batch_id long, arrival long")
    (kept,) = ingest.current_rows(raw).collect()
    assert kept.value == 80.0 and "arrival" not in kept.asDict()
    clean = raw.drop("batch_id", "arrival")
    assert ingest.current_rows(clean) is clean


def test_metric_history_pages(spark):
    rows = [("a", at(-i), "spo2", float(i)) for i in range(30)] + [("a", at(-i), "heart_rate", float(i)) for i in range(3)]
    df = vitals(spark, rows)
    page = vt.metric_history(df, 5, offset=5)
    assert sorted(r.value for r in page.collect()) == [5.0, 6.0, 7.0, 8.0, 9.0]
    one = vt.metric_history(df, 5, offset=5, patient_id="a", metric_name="spo2")
    assert [r.value for r in one.collect()] == [5.0, 6.0, 7.0, 8.0, 9.0]
    # the metric filter precedes the limit
    only = vt.metric_history(df, 2, metric_name="heart_rate")
    assert sorted(r.value for r in only.collect()) == [0.0, 1.0]
    assert vt.metric_history(df, 500, offset=498).count() == 0


def test_latest_readings_skip_nulls_after_the_cap(spark):
    rows = [
        ("a", at(0), "spo2", None),
        ("a", at(-10), "spo2", 95.0),
        ("a", at(-20), "spo2", 94.0),
        ("a", at(-5), "unknown_metric", 1.0),
        ("a", at(-1801), "heart_rate", 70.0),
    ]
    df = vitals(spark, rows)
    assert [(r.metric_name, r.value) for r in vt.latest_readings(df, AS_OF).collect()] == [("spo2", 95.0)]
    # the null row and the unknown metric use up a cap of two
    assert vt.latest_readings(df, AS_OF, cap=2).count() == 0


def test_cap_of_two_hundred_readings_hides_older_metrics(spark):
    rows = [("a", at(-i), "spo2", 97.0) for i in range(200)] + [("a", at(-300), "heart_rate", 180.0)]
    got = vt.latest_readings(vitals(spark, rows), AS_OF).collect()
    assert [(r.metric_name, r.value) for r in got] == [("spo2", 97.0)]


def test_metric_cards_and_overview(spark):
    rows = [("a", at(-i), "spo2", 90.0 + i) for i in range(5)] + [("a", at(-9), "heart_rate", 130.0)]
    cards = vt.metric_cards(vitals(spark, rows)).orderBy("metric_name", "position").collect()
    assert [(r.metric_name, r.position, r.value, r.range_status) for r in cards] == [
        ("heart_rate", 1, 130.0, "high"), ("spo2", 1, 90.0, "low"), ("spo2", 2, 91.0, "low"), ("spo2", 3, 92.0, "low"),
    ]
    people = profiles(spark, ("a", 0.1), ("b", 0.2))
    pages = {r.patient_id: r.cards for r in vt.patient_overview(people, vitals(spark, rows)).collect()}
    assert [(x.metric_name, x.position) for x in pages["a"]] == [("heart_rate", 1), ("spo2", 1), ("spo2", 2), ("spo2", 3)]
    assert pages["b"] == []


def test_card_unit_is_the_newest_reading_s(spark):
    rows = [("a", at(0), "temperature", 37.0, "C"), ("a", at(-1), "temperature", 98.6, "F")]
    got = vt.metric_cards(spark.createDataFrame(rows, VITALS)).orderBy("position").collect()
    assert [(r.unit, r.card_unit) for r in got] == [("C", "C"), ("F", "C")]


# Deduplication and bad records


def test_dedup_latest_keeps_the_last_arrival_and_is_idempotent(spark):
    rows = [("a", at(0), "spo2", 1.0, 1), ("a", at(0), "spo2", 2.0, 2), ("a", at(0), "spo2", None, 2), ("b", at(0), "spo2", 5.0, 1)]
    df = spark.createDataFrame(
        [(p, t, m, v, "u", n) for p, t, m, v, n in rows], VITALS + ", arrival int"
    )
    once = ingest.dedup_latest(df, "arrival")
    assert sorted((r.patient_id, r.value) for r in once.collect()) == [("a", 2.0), ("b", 5.0)]
    assert sorted(ingest.dedup_latest(once, "arrival").collect()) == sorted(once.collect())


def test_decode_and_split(spark):
    messages = [
        '{"patient_id":"P-1","metric_name":"spo2","value":97.5,"unit":"%","timestamp":"2024-01-02 11:59:00"}',
        '{"patient_id":"P-1","metric_name":"spo2","value":null,"unit":"%","timestamp":"2024-01-02 11:58:00"}',
        '{"patient_id":"P-1","metric_name":"spo2","value":"high","unit":"%","timestamp":"2024-01-02 11:57:00"}',
        '{"metric_name":"spo2","value":97.5,"unit":"%","timestamp":"2024-01-02 11:59:00"}',
        '{"patient_id":"P-1","metric_name":"spo2","value":97.5,"unit":"%","timestamp":"soon"}',
        '{"patient_id":"P-1", "metric_name"',
        "not json",
        "",
        None,
    ]
    df = spark.createDataFrame([(m.encode() if m is not None else None,) for m in messages], "value binary")
    good, bad = ingest.split_bad_records(ingest.decode_vitals(df, raw_as="raw"))
    assert sorted((r.value is None, r.patient_id) for r in good.collect()) == [(False, "P-1"), (True, "P-1"), (True, "P-1")]
    assert bad.count() == 6
    assert sorted(str(r.raw) for r in bad.collect()) == sorted(str(m) for m in messages[3:])


# Alerts


def test_alert_projections_and_replayed_ids(spark):
    rows = vitals(spark, [("a", at(0), "heart_rate", 121.0), ("a", at(0), "spo2", 99.0)])
    found = al.classify_alerts(rows)
    base = al.alerts_base(found)
    assert base.columns == ["alert_id", "patient_id", "metric_name", "observed_value", "alert_type", "timestamp", "status"]
    assert al.alerts_by_day(found).columns[:3] == ["day", "timestamp", "alert_id"]
    assert al.alerts_by_patient(found).columns[:3] == ["patient_id", "timestamp", "alert_id"]
    row = base.first()
    assert (row.observed_value, row.alert_type, row.status) == (121.0, "TACHYCARDIA", "ACTIVE")
    assert al.alerts_by_day(al.classify_alerts(rows)).first().alert_id == row.alert_id


def test_active_status_and_formatting(spark):
    rows = [("1", "a", None, at(0), "active"), ("2", "a", 1.0, at(0), None), ("3", "a", 1.0, at(0), "Resolved"), ("4", "a", 2.0, at(0), "ACTIVE")]
    df = alerts(spark, rows)
    assert sorted(r.alert_id for r in al.active_alerts(df).collect()) == ["1", "4"]
    shown = {r.alert_id: r for r in al.format_alerts(df).collect()}
    assert (shown["1"].observed_value, shown["1"].status, shown["1"].timestamp) == (0.0, "ACTIVE", "2024-01-02 12:00:00")
    assert (shown["2"].status, shown["3"].status) == ("", "RESOLVED")


def test_recent_alerts_scan_then_filter_then_limit(spark):
    rows = [(f"{i:03d}", "a", 1.0, at(-i), "RESOLVED" if i < 10 else "ACTIVE") for i in range(300)]
    df = alerts(spark, rows)
    # the scan of 12 newest rows holds two active ones
    assert [r.alert_id for r in al.recent_alerts(df, AS_OF, limit=5, scan_limit=12).collect()] == ["010", "011"]
    # the scan limit is at least the limit
    assert al.recent_alerts(df, AS_OF, limit=20, scan_limit=1).count() == 10
    # two hundred are asked for, one hundred are given
    assert al.recent_alerts(df, AS_OF, limit=200).count() == 100
    assert al.recent_alerts(df, AS_OF, limit=0, scan_limit=500).count() == 1


def test_recent_alerts_stop_at_midnight_unless_unbounded(spark):
    early = datetime(2024, 1, 2, 0, 10)
    rows = [("1", "a", 1.0, datetime(2024, 1, 2, 0, 5, tzinfo=timezone.utc), "ACTIVE"), ("2", "a", 1.0, datetime(2024, 1, 1, 23, 55, tzinfo=timezone.utc), "ACTIVE")]
    df = alerts(spark, rows)
    assert [r.alert_id for r in al.recent_alerts(df, early).collect()] == ["1"]
    assert [r.alert_id for r in al.recent_alerts(df, early, day_bounded=False).collect()] == ["1", "2"]


def test_patient_alerts_limit_precedes_status(spark):
    rows = [("1", "a", 1.0, at(0), "RESOLVED"), ("2", "a", 1.0, at(-1), "ACTIVE"), ("3", "a", 1.0, at(-2), "ACTIVE"), ("4", "b", 1.0, at(-3601), "ACTIVE")]
    df = alerts(spark, rows)
    assert sorted(r.alert_id for r in al.patient_alerts(df, AS_OF, limit=2).collect()) == ["1", "2"]
    assert [r.alert_id for r in al.patient_alerts(df, AS_OF, limit=2, active_only=True).collect()] == ["2"]
    assert [r.alert_id for r in al.patient_alerts(df, AS_OF, patient_id="a").collect()] == ["1", "2", "3"]
    assert al.patient_alerts(df, AS_OF, patient_id="b").count() == 0
    assert al.patient_alerts(df, AS_OF, patient_id="b", since_minutes=61).count() == 1


def test_alert_count_looks_at_the_newest_fifty(spark):
    rows = [(f"{i:03d}", "a", 1.0, at(-i), "RESOLVED" if i < 45 else "ACTIVE") for i in range(80)]
    rows += [("x", "b", 1.0, at(-1800), "ACTIVE"), ("y", "b", 1.0, at(-1801), "ACTIVE")]
    got = {r.patient_id: r.active_alerts for r in al.active_alert_counts(alerts(spark, rows), AS_OF).collect()}
    assert got == {"a": 5, "b": 1}


# Risk


def test_risk_scores(spark):
    people = profiles(spark, ("none", 0.5), ("alerts", 0.5), ("one", 0.5), ("both", 0.5), ("capped", 0.5))
    readings = vitals(
        spark,
        [
            ("one", at(0), "heart_rate", 100.0),
            ("both", at(0), "heart_rate", 100.0),
            ("both", at(0), "spo2", 90.0),
            ("capped", at(0), "heart_rate", 500.0),
            ("stranger", at(0), "heart_rate", 500.0),
            ("none", at(-1801), "heart_rate", 500.0),
        ],
    )
    warnings = alerts(
        spark,
        [(f"a{i}", "alerts", 1.0, at(-i), "ACTIVE") for i in range(2)]
        + [(f"b{i}", "both", 1.0, at(-i), "ACTIVE") for i in range(7)]
        + [("c0", "capped", 1.0, at(0), "ACTIVE")],
    )
    got = {r.patient_id: r for r in rk.risk_scores(people, readings, warnings, AS_OF).collect()}
    assert set(got) == {"none", "alerts", "one", "both", "capped"}
    assert got["none"].risk_score is None and got["none"].metric_score is None
    assert got["alerts"].risk_score == pytest.approx(0.2)
    assert got["one"].risk_score == pytest.approx(0.2)
    # weights are renormalised over the metrics present; alerts add at most 0.3
    both = (0.20 * 0.2 + 0.25 * 1.0) / 0.45
    assert got["both"].risk_score == pytest.approx(min(1.0, both + 0.3))
    assert got["capped"].risk_score == 1.0


def test_changed_risk(spark):
    scores = spark.createDataFrame(
        [("same", 0.5004), ("more", 0.502), ("new", 0.1), ("null", None), ("stranger", 0.9)],
        "patient_id string, risk_score double",
    )
    people = profiles(spark, ("same", 0.5), ("more", 0.5), ("new", None), ("null", 0.5))
    changed = rk.changed_risk(scores, people)
    assert sorted(r.patient_id for r in changed.collect()) == ["more", "new"]
    assert rk.update_count(changed).first().updated == 2


def test_bands_ranking_and_list(spark):
    people = profiles(spark, ("b", 0.5), ("a", 0.5), ("c", 0.505), ("d", None), ("e", 0.999))
    got = {r.patient_id: (r.risk_band, r.risk_pct, r.risk_pct_floor) for r in rk.with_risk_band(people).collect()}
    assert got == {"a": ("green", 50, 50), "b": ("green", 50, 50), "c": ("red", 51, 50), "d": ("green", 0, 0), "e": ("red", 100, 99)}
    assert [r.patient_id for r in rk.ward_ranking(people).collect()] == ["e", "c", "a", "b", "d"]
    assert [tuple(r) for r in rk.risk_list(people).limit(1).collect()] == [("a", 0.5, None)]


# Profiles


def test_patches_follow_their_sequence_and_insert_nobody(spark):
    people = profiles(spark, ("a", 0.1), ("b", 0.2), ("c", 0.3))
    edits = spark.createDataFrame(
        [
            ("a", 1, " First ", "e1", "1", "n1"),
            ("a", 2, "Second", None, " 2 ", "n2"),
            ("b", 1, "  ", "e", "1", "n"),
            ("stranger", 1, "Nobody", "e", "1", "n"),
        ],
        "patient_id string, seq long, name string, email string, phone string, medical_notes string",
    )
    got = {r.patient_id: r for r in pr.apply_patches(people, pr.edit_patches(edits, AS_OF)).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].name, tuple(got["a"].contact_info), got["a"].medical_notes) == ("Second", ("", "2"), "n2")
    assert got["b"].name == "name b" and got["c"].name == "name c"
    assert got["a"].risk_score == 0.1


def test_partial_patches_and_explicit_nulls(spark):
    people = profiles(spark, ("a", 0.1), ("b", 0.2))
    patches = spark.createDataFrame(
        [("a", 1, "Name 1", True, None, False), ("a", 2, None, False, None, True), ("b", 1, None, True, "kept?", False)],
        "patient_id string, seq long, name string, set_name boolean, medical_notes string, set_medical_notes boolean",
    )
    got = {r.patient_id: (r.name, r.medical_notes) for r in pr.apply_patches(people, patches).collect()}
    assert got == {"a": ("Name 1", None), "b": (None, "notes")}


def test_known_patients_and_lookup(spark):
    people = profiles(spark, ("a", 0.1), ("b", 0.2))
    rows = vitals(spark, [("a", at(0), "spo2", 1.0), ("z", at(0), "spo2", 2.0)])
    assert [r.patient_id for r in pr.known_patients(rows, people).collect()] == ["a"]
    assert pr.profile_of(people, "b").first().name == "name b"
    assert pr.profile_of(people, "z").count() == 0


# Summary


def test_summary_of_all_days_is_the_union_of_its_days(spark):
    rng = random.Random(3)
    rows = [(f"p{rng.randrange(5)}", at(-rng.randrange(3 * 86400)), rng.choice(c.METRIC_NAMES), rng.random()) for _ in range(400)]
    df = vitals(spark, rows + [("p", None, "spo2", 1.0), ("p9", at(0), "spo2", None)])
    everything = sm.daily_summary(df)
    days = sorted({r.stat_date for r in everything.collect()})
    by_day = [r for d in days for r in sm.daily_summary(df, d).collect()]
    key = lambda r: (r.stat_date, r.metric_name)
    assert sorted(everything.collect(), key=key) == sorted(by_day, key=key)
    assert [f.dataType.simpleString() for f in everything.schema] == ["date", "string", "double", "double", "double", "int"]
    one = [r.metric_name for r in sm.read_daily_summary(everything, days[0]).collect()]
    assert one == sorted(one)


# Order statistics and features


@pytest.mark.parametrize("size", [1, 2, 3, 10, 997, 5000, 20011])
def test_exact_median(spark, size):
    rng = random.Random(size)
    for values in (
        [rng.random() for _ in range(size)],
        [float(rng.randrange(3)) for _ in range(size)],
        [rng.paretovariate(0.5) for _ in range(size)],
    ):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
        assert exact_median(df, "x").first().median == statistics.median(values)
        # a coarse sketch only widens the bracket
        assert exact_median(df, "x", accuracy=50).first().median == statistics.median(values)


def test_exact_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "x double"), "x").first().median is None


def test_features_fill_and_label(spark):
    rows = vitals(
        spark,
        [("a", at(0), "heart_rate", 60.0), ("a", at(-9), "heart_rate", 80.0), ("b", at(0), "spo2", 95.0), ("b", at(-5), "spo2", float("nan")),
         ("c", at(0), "heart_rate", 90.0), ("c", at(days=-1), "spo2", 91.0), ("c", at(-86401), "spo2", 11.0), ("z", at(0), "spo2", 1.0)],
    )
    people = profiles(spark, ("a", None), ("b", None), ("c", None))
    assert ft.patient_features(rows, AS_OF, profiles=people).columns == ["patient_id", "heart_rate", "spo2"]
    features = ft.patient_features(rows, AS_OF, profiles=people, metrics=c.METRIC_NAMES)
    assert features.columns == ["patient_id", *sorted(c.METRIC_NAMES)]
    got = {r.patient_id: (r.heart_rate, r.spo2) for r in features.collect()}
    assert got == {"a": (70.0, 0.0), "b": (0.0, 95.0), "c": (90.0, 91.0)}
    for approx in (False, True):
        labelled = ft.label_high_risk(features, approx=approx)
        assert {r.patient_id: r.high_risk for r in labelled.collect()} == {"a": 0, "b": 0, "c": 1}
    assert sorted(map(tuple, ft.label_distribution(labelled).collect())) == [(0, 2), (1, 1)]
    assert ft.patient_features(rows, AS_OF, fill=None).filter("heart_rate IS NULL").count() == 2
    without = ft.patient_features(rows, AS_OF, metrics=("temperature", "spo2"))
    assert ft.label_column(without) == "spo2"


def test_split_is_stable_and_complete(spark):
    df = spark.range(5000).select(F.concat(F.lit("P-"), F.col("id")).alias("patient_id"))
    train, test = ft.split(df)
    first = {r.patient_id for r in train.collect()}
    assert first == {r.patient_id for r in ft.split(df.repartition(11))[0].collect()}
    assert first | {r.patient_id for r in test.collect()} == {r.patient_id for r in df.collect()}
    assert train.count() + test.count() == 5000
    assert 0.66 < len(first) / 5000 < 0.74
    assert first != {r.patient_id for r in ft.split(df, seed=7)[0].collect()}
    assert ft.split(df, 1.0)[1].count() == 0 and ft.split(df, 0.0)[0].count() == 0


@pytest.mark.parametrize("size, share, trained", [(20, 0.7, 14), (10, 0.75, 7), (1, 0.7, 0), (3, 1.0, 3), (7, 0.0, 0), (1000, 0.3, 300)])
def test_exact_split_counts(spark, size, share, trained):
    df = spark.range(size).select(F.concat(F.lit("P-"), F.col("id")).alias("patient_id"))
    train, test = ft.split(df, share, exact=True)
    assert (train.count(), test.count()) == (trained, size - trained)


def test_exact_cut_with_a_coarse_sketch(spark):
    rng = random.Random(5)
    values = [rng.random() for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    for share in (0.001, 0.3, 0.7, 0.999, 1.0):
        rank = int(share * 5000 + 1e-9)
        assert exact_cut(df, "x", share, accuracy=100).first().cut == sorted(values)[rank - 1]


def test_top_n_rank_column_and_range(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "k string, i int")
    got = top_n(df, ["k"], [F.col("i").desc()], 4, first=3, rank_as="place", splits=2).collect()
    assert sorted((r.place, r.i) for r in got) == [(3, 7), (4, 6)]


def test_narrowing_takes_as_many_rounds_as_it_needs(spark):
    values = [float(i * i % 99991) for i in range(20_000)] + [5.0] * 30_000
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    want = statistics.median(values)
    assert exact_median(df, "x", accuracy=1000, rounds=3, most=60).first().median == want
    with pytest.raises(Exception, match="more than 60 distinct values"):
        exact_median(df, "x", accuracy=1000, rounds=1, most=60).collect()
    assert exact_cut(df, "x", 0.9, accuracy=1000, rounds=3, most=60).first().cut == sorted(values)[45_000 - 1]


def test_pages_by_cursor_equal_pages_by_offset(spark):
    rows = [(p, at(-i), m, float(i)) for p in "ab" for m in ("spo2", "heart_rate") for i in range(23)]
    df = vitals(spark, rows)
    shown = vt.metric_history(df, 5)
    for page in range(1, 6):
        by_offset = sorted(vt.metric_history(df, 5, offset=5 * page).collect())
        following = vt.next_pages(df, shown, 5)
        assert sorted(following.collect()) == by_offset
        shown = shown.unionByName(following)
    one = vt.newest_vitals(df, 500, patient_id="a").collect()
    for k in (0, 1, 17, 45):
        after = (one[k].timestamp, one[k].metric_name)
        assert vt.newest_vitals(df, 7, patient_id="a", after=after).collect() == one[k + 1 : k + 8]


def test_too_many_metric_names_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(ft, "MOST_METRICS", 3)
    rows = [("a", at(0), f"m{i}", 1.0) for i in range(4)]
    assert ft.wide_means(vitals(spark, rows[:3])).columns == ["patient_id", "m0", "m1", "m2"]
    with pytest.raises(ValueError):
        ft.wide_means(vitals(spark, rows))


def test_overview_of_one_patient(spark):
    rows = vitals(spark, [("a", at(0), "spo2", 95.0), ("b", at(0), "spo2", 96.0)])
    people = profiles(spark, ("a", None), ("b", None))
    (page,) = vt.patient_overview(people, rows, patient_id="b").collect()
    assert page.patient_id == "b" and [card.value for card in page.cards] == [96.0]
