"""Fixed values that decide results. This is their only copy."""

from typing import NamedTuple


class Metric(NamedTuple):
    name: str
    min_ok: float
    max_ok: float
    weight: float
    unit: str
    description: str


class AlertRule(NamedTuple):
    metric: str
    comparator: str
    threshold: float
    alert_type: str


# Normal range, risk weight, unit and display text of each metric.
METRICS = (
    Metric("heart_rate", 60.0, 100.0, 0.20, "bpm", "Heart rate"),
    Metric("bp_systolic", 110.0, 130.0, 0.15, "mmHg", "Systolic blood pressure"),
    Metric("bp_diastolic", 70.0, 85.0, 0.10, "mmHg", "Diastolic blood pressure"),
    Metric("spo2", 95.0, 100.0, 0.25, "%", "Oxygen level"),
    Metric("temperature", 36.5, 37.5, 0.15, "C", "Body temperature"),
    Metric("respiratory_rate", 12.0, 18.0, 0.15, "bpm", "Breathing rate"),
)

METRIC_NAMES = tuple(m.name for m in METRICS)

# Alert rules, tried in this order; comparisons are strict.
ALERT_RULES = (
    AlertRule("heart_rate", ">", 120.0, "TACHYCARDIA"),
    AlertRule("spo2", "<", 92.0, "HYPOXIA"),
    AlertRule("temperature", ">", 39.0, "FEVER"),
)

# Texts for metrics without a configured range.
UNKNOWN_METRIC_DESCRIPTION = "Metric"
RANGE_NOT_SET = "Normal range not set"

# Risk score.
IN_RANGE_SHARE = 0.2
OUT_OF_RANGE_SHARE = 0.8
SMALLEST_HALF_RANGE = 1e-9
ALERT_STEP = 0.10
ALERT_CEILING = 0.30
RISK_CHANGE_TOLERANCE = 0.001
RISK_BAND_THRESHOLD = 0.5
RISK_SOURCE = "auto_vitals_v1"

# Default and largest sizes of the reads.
MINUTES_PER_DAY = 24 * 60
MAX_VITALS = 500
MAX_ALERTS = 100
MAX_ALERT_SCAN = 2000
MAX_PATIENT_ALERTS = 200
VITALS_CAP = 200
ALERT_COUNT_CAP = 50
RISK_MINUTES = 30
CARD_ROWS = 3

# Fixed value: status written with a new alert and asked for by the alert reads.
ACTIVE = "ACTIVE"

# Fixed value: how event times are written as text.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
