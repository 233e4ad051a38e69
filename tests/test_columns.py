"""Column functions on literal values, compared with plain Python where that is the reference point."""

import math
from datetime import date, datetime, timezone

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from wardflow.functions import columns as col, constants as c
from wardflow.operators import vitals as vt
from wardflow.operators.summary import format_daily_summary, resolve_stat_date


def expected_risk(value, low, high):
    """The score is the straight line between five points, and flat beyond them."""
    middle, half = (low + high) / 2, (high - low) / 2
    return np.interp(value, [low - half, low, middle, high, high + half], [1.0, 0.2, 0.0, 0.2, 1.0])


def risks(spark, rows):
    df = spark.createDataFrame(rows, "v double, lo double, hi double")
    return [r[0] for r in df.select(col.metric_risk(F.col("v"), F.col("lo"), F.col("hi"))).collect()]


def test_metric_risk_at_the_ends_of_the_range(spark):
    rows = [(60.0, 60.0, 100.0), (100.0, 60.0, 100.0), (80.0, 60.0, 100.0), (120.0, 60.0, 100.0), (20.0, 60.0, 100.0)]
    assert risks(spark, rows) == pytest.approx([0.2, 0.2, 0.0, 1.0, 1.0])


def test_metric_risk_of_nan_null_and_empty_range(spark):
    assert risks(spark, [(math.nan, 60.0, 100.0), (None, 60.0, 100.0), (5.0, 5.0, 5.0), (5.1, 5.0, 5.0)]) == [
        1.0, None, 0.0, 1.0,
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=20, max_size=60))
def test_metric_risk_is_bounded_and_equals_python(spark, values):
    rows = [(float(v), m.min_ok, m.max_ok) for v in values for m in c.METRICS]
    got = risks(spark, rows)
    assert all(0.0 <= r <= 1.0 for r in got)
    assert got == pytest.approx([expected_risk(*row) for row in rows], abs=1e-9)


def test_metric_risk_grows_outside_the_range(spark):
    got = risks(spark, [(100.0 + step / 4, 60.0, 100.0) for step in range(0, 120)])
    assert got == sorted(got) and got[0] == pytest.approx(0.2)


def test_alert_rules_are_strict_and_first_match_wins(spark):
    rows = [
        ("heart_rate", 120.0), ("heart_rate", 120.01), ("spo2", 92.0), ("spo2", 91.99), ("temperature", 39.0),
        ("temperature", 39.01), ("bp_systolic", 999.0), ("heart_rate", None), (None, 500.0), ("heart_rate", math.nan),
    ]
    df = spark.createDataFrame(rows, "m string, v double")
    got = [r[0] for r in df.select(col.alert_type(F.col("m"), F.col("v"))).collect()]
    assert got == [None, "TACHYCARDIA", None, "HYPOXIA", None, "FEVER", None, None, None, "TACHYCARDIA"]
    twice = (c.AlertRule("m", ">", 1.0, "FIRST"), c.AlertRule("m", ">", 0.0, "SECOND"))
    df = spark.createDataFrame([("m", 2.0), ("m", 0.5)], "m string, v double")
    assert [r[0] for r in df.select(col.alert_type(F.col("m"), F.col("v"), twice)).collect()] == ["FIRST", "SECOND"]
    assert df.select(col.alert_type(F.col("m"), F.col("v"), ())).first()[0] is None


def test_range_status_and_texts(spark):
    rows = [
        ("heart_rate", 60.0), ("heart_rate", 59.9), ("heart_rate", 100.0), ("heart_rate", 100.1),
        ("temperature", None), ("blood_sugar", 5.0),
    ]
    df = vt.with_range_status(spark.createDataFrame(rows, "metric_name string, value double"))
    got = {(r.metric_name, r.value): r for r in df.collect()}
    assert got["heart_rate", 60.0].range_status == "normal"
    assert got["heart_rate", 59.9].range_status == "low"
    assert got["heart_rate", 59.9].range_warning == "Below normal range"
    assert got["heart_rate", 100.0].range_status == "normal"
    assert got["heart_rate", 100.1].range_status == "high"
    assert got["heart_rate", 100.1].range_text == "60 - 100"
    assert got["temperature", None].range_status is None
    assert got["temperature", None].range_text == "36.5 - 37.5"
    unknown = got["blood_sugar", 5.0]
    assert (unknown.range_status, unknown.range_text, unknown.description, unknown.metric_label) == (
        "normal", "Normal range not set", "Metric", "Blood Sugar",
    )


def test_one_sided_ranges(spark):
    reference = spark.createDataFrame(
        [("a", 1.0, None, 1.0, "A"), ("b", None, 2.5, 1.0, "B")],
        "metric_name string, min_ok double, max_ok double, weight double, description string",
    )
    rows = spark.createDataFrame([("a", 0.0), ("a", 9.0), ("b", 9.0)], "metric_name string, value double")
    got = [(r.range_text, r.range_status) for r in vt.with_range_status(rows, reference).orderBy("metric_name", "value").collect()]
    assert got == [("≥ 1", "low"), ("≥ 1", "normal"), ("≤ 2.5", "high")]


def test_metric_label_changes_first_letters_only(spark):
    df = spark.createDataFrame([("bp_systolic",), ("SPO2_max",), ("",)], "m string")
    assert [r[0] for r in df.select(col.metric_label(F.col("m"))).collect()] == ["Bp Systolic", "SPO2 Max", ""]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-1e6, 1e6).filter(lambda x: x >= 0 or x <= -0.01), min_size=20, max_size=40),
    st.lists(st.integers(-10**6, 10**6), min_size=20, max_size=40),
)
def test_two_decimals_equals_exact_rounding(spark, floats, thousandths):
    values = floats + [n / 1000 for n in thousandths if n >= 0 or n <= -10] + [2.675, 1.005, 0.125, 0.375, 1.015]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(col.two_decimals(F.col("v"))).collect()]
    assert got == ["%.2f" % v for v in values]


def test_daily_summary_display_of_null(spark):
    row = (date(2024, 1, 2), "spo2", None, 95.0, 97.255, 3)
    df = spark.createDataFrame([row], "stat_date date, metric_name string, avg_value double, min_value double, max_value double, patient_count int")
    assert tuple(format_daily_summary(df).first()) == ("2024-01-02", "Spo2", "", "95.00", "%.2f" % 97.255, 3)


def test_strip_text_as_python_does(spark):
    texts = ["  a b ", "\t\n x  ", " y\x1c", "", None, "   "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(col.strip_text(F.col("t"))).collect()] == [(t or "").strip() for t in texts]


def test_event_time_of_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",), (None,), ("2024-13-40 00:00:00",)], "t string")
    got = [r[0] for r in df.select(col.time_text(col.event_time(F.col("t")))).collect()]
    assert got == ["2024-01-02 03:04:05", None, None, None]


def test_clamp():
    assert [col.clamp(v, 1, 500) for v in (0, -3, 1, "20", 500, 10_000)] == [1, 1, 1, 20, 500, 500]


def test_instants_given_in_three_ways(spark):
    moments = ["2024-01-02 12:00:00", datetime(2024, 1, 2, 12), datetime(2024, 1, 2, 12, tzinfo=timezone.utc)]
    row = spark.range(1).select(*[col.instant(m).cast("long").alias(f"t{i}") for i, m in enumerate(moments)]).first()
    assert set(row) == {1704196800}


def test_resolve_stat_date():
    today = datetime(2024, 1, 2, 23, 59)
    assert resolve_stat_date(None, today) == date(2024, 1, 2)
    assert resolve_stat_date(" ", today) == date(2024, 1, 2)
    assert resolve_stat_date("2023-05-06", today) == date(2023, 5, 6)
    assert resolve_stat_date("yesterday", today) == date(2024, 1, 2)
    with pytest.raises(ValueError):
        resolve_stat_date("yesterday", today, strict=True)
