"""Recompute all risk scores and store those that changed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wardflow.functions import constants as c
from wardflow.operators import ingest
from wardflow.operators.profiles import apply_patches, risk_patches
from wardflow.operators.risk import changed_risk, risk_scores
from wardflow.operators.vitals import since
from wardflow.session import ensure_checkpoint_dir
from wardflow.sources import log, tables


def refreshed_profiles(
    profiles: DataFrame, vitals: DataFrame, alerts: DataFrame, as_of: datetime | str, **sizes
) -> DataFrame:
    """The profiles with changed scores, their time and source set."""
    changed = changed_risk(risk_scores(profiles, vitals, alerts, as_of, **sizes), profiles)
    return apply_patches(profiles, risk_patches(changed, as_of))


def run_risk_refresh(
    spark: SparkSession, profiles_path: str, vitals_path: str, alerts_root: str, as_of: datetime | str
) -> int:
    """Store the refreshed profiles as the table's next snapshot; the number of profiles updated.

    Nothing is written if no score has changed, so running the job again gives 0. Readings and alerts that
    the stream stored more than once count once. If another refresh commits meanwhile, this one fails.
    """
    before = log.state(spark, profiles_path)
    profiles = tables.load_profiles(spark, profiles_path)
    vitals = ingest.current_rows(since(tables.load_vitals(spark, vitals_path), as_of, c.RISK_MINUTES))
    alerts = since(tables.load_alerts_by_patient(spark, alerts_root), as_of, c.RISK_MINUTES)
    alerts = ingest.current_rows(alerts, keys=["alert_id"])
    ensure_checkpoint_dir(spark)
    changed = changed_risk(risk_scores(profiles, vitals, alerts, as_of), profiles).checkpoint()
    updated = changed.count()
    if updated:
        tables.refresh_profiles(apply_patches(profiles, risk_patches(changed, as_of)), profiles_path, before)
    return updated
