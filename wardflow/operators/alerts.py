"""Anomaly classification, the three alert layouts, and the alert reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions import columns as col, constants as c
from wardflow.operators.vitals import newest_per_patient, since
from wardflow.schemas import HEALTH_ALERTS, HEALTH_ALERTS_BY_DAY, HEALTH_ALERTS_BY_PATIENT


def classify_alerts(vitals: DataFrame, rules: Sequence[c.AlertRule] = c.ALERT_RULES) -> DataFrame:
    """The readings that break a rule, with alert_type, day, alert_id and status."""
    kind = col.alert_type(F.col("metric_name"), F.col("value"), rules)
    return (
        vitals.withColumn("alert_type", kind)
        .filter(F.col("alert_type").isNotNull())
        .withColumn("day", F.to_date("timestamp"))
        .withColumn(
            "alert_id",
            col.alert_id(F.col("patient_id"), F.col("metric_name"), F.col("timestamp"), F.col("alert_type")),
        )
        .withColumn("status", F.lit(c.ACTIVE))
        .withColumnRenamed("value", "observed_value")
    )


def alerts_base(alerts: DataFrame) -> DataFrame:
    return alerts.select(*HEALTH_ALERTS.names)


def alerts_by_day(alerts: DataFrame) -> DataFrame:
    return alerts.select(*HEALTH_ALERTS_BY_DAY.names)


def alerts_by_patient(alerts: DataFrame) -> DataFrame:
    return alerts.select(*HEALTH_ALERTS_BY_PATIENT.names)


def newest_first() -> list[Column]:
    return [F.col("timestamp").desc(), F.col("alert_id").asc()]


def active_alerts(alerts: DataFrame) -> DataFrame:
    """Status ACTIVE in any case; a null status is not active."""
    return alerts.filter(col.is_active(F.col("status")))


def format_alerts(alerts: DataFrame) -> DataFrame:
    """The seven columns the alert reads return: null value as 0.0, time as text, status upper case."""
    return alerts.select(
        F.col("alert_id").cast("string").alias("alert_id"),
        "patient_id",
        "metric_name",
        F.coalesce(F.col("observed_value"), F.lit(0.0)).alias("observed_value"),
        "alert_type",
        col.time_text(F.col("timestamp")).alias("timestamp"),
        F.upper(F.coalesce(F.col("status"), F.lit(""))).alias("status"),
    )


def recent_alerts(
    alerts: DataFrame,
    as_of: datetime | str,
    *,
    limit: int = 20,
    since_minutes: int = 30,
    scan_limit: int = 500,
    day_bounded: bool = True,
) -> DataFrame:
    """Newest active alerts of the whole ward.

    The status filter applies to the newest ``scan_limit`` rows only, so more active alerts may
    exist than are returned. ``day_bounded`` reads the partition of ``as_of``'s own day, which cuts
    a lookback at midnight; False looks back the full span. The lookback keeps a prefix of the
    newest-first order, so taking it before the scan limit gives the same rows and prunes the scan.
    """
    limit = col.clamp(limit, 1, c.MAX_ALERTS)
    scan_limit = max(limit, min(int(scan_limit), c.MAX_ALERT_SCAN))
    scan = since(alerts, as_of, col.clamp(since_minutes, 1, c.MINUTES_PER_DAY))
    if day_bounded:
        scan = scan.filter(F.col("day") == F.to_date(col.instant(as_of)))
    newest = scan.orderBy(*newest_first()).limit(scan_limit)
    kept = active_alerts(newest).orderBy(*newest_first()).limit(limit)
    return format_alerts(kept)


def patient_alerts(
    alerts: DataFrame,
    as_of: datetime | str,
    *,
    limit: int | None = 50,
    since_minutes: int = 60,
    patient_id: str | None = None,
    active_only: bool = False,
    splits: int = 1,
) -> DataFrame:
    """Recent alerts per patient: the newest ``limit`` rows (None: all), then the lookback.

    Naming a patient is a request: the limit is brought into 1 to 200, the lookback into a day.

    Alerts of every status are returned; ``active_only`` filters after the limit. As in
    :func:`recent_alerts` the lookback is a prefix of the order and is applied first.
    """
    if patient_id is not None:
        since_minutes = col.clamp(since_minutes, 1, c.MINUTES_PER_DAY)
        limit = col.clamp(c.MAX_PATIENT_ALERTS if limit is None else limit, 1, c.MAX_PATIENT_ALERTS)
    scan = since(alerts, as_of, since_minutes)
    if patient_id is not None:
        newest = scan.filter(F.col("patient_id") == patient_id).orderBy(*newest_first()).limit(limit)
    else:
        newest = newest_per_patient(scan, newest_first(), limit, splits)
    return format_alerts(active_alerts(newest) if active_only else newest)


def active_alert_counts(
    alerts: DataFrame,
    as_of: datetime | str,
    *,
    minutes: int = c.RISK_MINUTES,
    cap: int | None = c.ALERT_COUNT_CAP,
    splits: int = 1,
) -> DataFrame:
    """Active alerts per patient among the newest ``cap`` alerts (None: all), inside the lookback."""
    newest = newest_per_patient(since(alerts, as_of, minutes), newest_first(), cap, splits)
    return active_alerts(newest).groupBy("patient_id").agg(F.count("*").alias("active_alerts"))
