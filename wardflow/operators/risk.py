"""Risk scores of all patients in one plan, and the reads over stored scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wardflow.functions import columns as col, constants as c
from wardflow.operators.alerts import active_alert_counts
from wardflow.operators.vitals import latest_readings, with_reference


def with_metric_risk(readings: DataFrame) -> DataFrame:
    """Add ``risk`` (0 to 1) to readings of configured metrics; other metrics drop out."""
    joined = with_reference(readings, "inner")
    return joined.withColumn("risk", col.metric_risk(F.col("value"), F.col("min_ok"), F.col("max_ok")))


def weighted_risk(readings: DataFrame, metrics: Sequence[c.Metric] = c.METRICS) -> DataFrame:
    """Weighted mean risk per patient over the metrics that are present.

    The six terms are added in a fixed order, so a score does not vary with the order of rows.
    """
    per_metric = [F.max(F.when(F.col("metric_name") == m.name, F.col("risk"))).alias(m.name) for m in metrics]
    wide = readings.groupBy("patient_id").agg(*per_metric)
    score = weight = F.lit(0.0)
    for m in metrics:
        score = score + F.coalesce(F.lit(m.weight) * F.col(m.name), F.lit(0.0))
        weight = weight + F.when(F.col(m.name).isNotNull(), m.weight).otherwise(0.0)
    return wide.filter(weight > 0).select("patient_id", (score / weight).alias("metric_score"))


def risk_scores(
    profiles: DataFrame,
    vitals: DataFrame,
    alerts: DataFrame,
    as_of: datetime | str,
    *,
    minutes: int = c.RISK_MINUTES,
    cap: int = c.VITALS_CAP,
    alert_minutes: int = c.RISK_MINUTES,
    alert_cap: int = c.ALERT_COUNT_CAP,
) -> DataFrame:
    """One row per profile: metric score, active alerts, risk score.

    The score is null for a patient with neither recent readings nor active alerts. Both inputs are
    reduced to one row per patient before they meet the profiles, so no join key is hot.
    """
    from_vitals = weighted_risk(with_metric_risk(latest_readings(vitals, as_of, minutes=minutes, cap=cap)))
    counts = active_alert_counts(alerts, as_of, minutes=alert_minutes, cap=alert_cap)
    joined = (
        profiles.select("patient_id")
        .join(from_vitals, "patient_id", "left")
        .join(counts, "patient_id", "left")
        .withColumn("active_alerts", F.coalesce("active_alerts", F.lit(0).cast("long")))
    )
    n = F.col("active_alerts").cast("double")
    raised = F.coalesce(F.col("metric_score"), F.lit(0.0)) + F.least(F.lit(c.ALERT_CEILING), n * c.ALERT_STEP)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), raised))
    return joined.withColumn("risk_score", F.when(F.col("metric_score").isNotNull() | (n > 0), bounded))


def changed_risk(
    scores: DataFrame, profiles: DataFrame, tolerance: float = c.RISK_CHANGE_TOLERANCE
) -> DataFrame:
    """Scores that differ from the stored one by ``tolerance`` or more, or have none stored."""
    stored = profiles.select("patient_id", F.col("risk_score").cast("double").alias("previous_score"))
    previous, score = F.col("previous_score"), F.col("risk_score")
    return (
        scores.select("patient_id", "risk_score")
        .filter(score.isNotNull())
        .join(stored, "patient_id", "inner")
        .filter(previous.isNull() | (F.abs(previous - score) >= tolerance))
    )


def update_count(changed: DataFrame) -> DataFrame:
    return changed.agg(F.count("*").alias("updated"))


def with_risk_band(profiles: DataFrame) -> DataFrame:
    """Band and percentages of the stored score; no score counts as 0."""
    score = F.coalesce(F.col("risk_score"), F.lit(0.0))
    return (
        profiles.withColumn("risk_band", F.when(score > c.RISK_BAND_THRESHOLD, "red").otherwise("green"))
        .withColumn("risk_pct", F.round(score * 100.0).cast("int"))
        .withColumn("risk_pct_floor", F.floor(score * 100.0).cast("int"))
    )


def ward_ranking(profiles: DataFrame) -> DataFrame:
    """All patients, highest stored risk first, then by id."""
    cards = with_risk_band(profiles).select(
        "patient_id",
        "name",
        "medical_notes",
        F.coalesce(F.col("risk_score"), F.lit(0.0)).alias("risk_score"),
        "risk_band",
        "risk_pct",
        "risk_pct_floor",
    )
    return cards.orderBy(F.col("risk_score").desc(), F.col("patient_id").asc())


def risk_list(profiles: DataFrame) -> DataFrame:
    """Stored scores with the time of their last update as text, by patient."""
    return profiles.select(
        "patient_id", "risk_score", col.time_text(F.col("risk_score_updated_at")).alias("risk_score_updated_at")
    ).orderBy("patient_id")
