"""Batch tables. Every read declares its schema; partition columns are found from the folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardflow import schemas
from wardflow.sources import log

VITALS = "patient_vitals"
VITALS_CLEAN = "patient_vitals_clean"
ALERTS = "health_alerts"
ALERTS_BY_DAY = "health_alerts_by_day"
ALERTS_BY_PATIENT = "health_alerts_by_patient"
QUARANTINE = "quarantine"
PATIENT_BUCKETS = 16
SNAPSHOT = "snapshot"


def load_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    options: Mapping | None = None,
    *,
    missing_ok: bool = False,
) -> DataFrame:
    """Read a table of any batch format; of a table with manifests, the folders that the newest lists.

    A path that does not exist is an error; with ``missing_ok`` it is an empty table, which is right only for what
    the stream has perhaps not written yet.
    """
    if fmt == "parquet" and (logged := log.load(spark, path, schema)) is not None:
        return logged
    try:
        return spark.read.format(fmt).schema(schema).options(**(options or {})).load(path)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_stream_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that the stream writes, with the batch of each row; an empty one if it has not written it yet."""
    if not log.state(spark, path).version:
        return load_table(spark, path, schema, missing_ok=True)
    return load_table(spark, path, schemas.with_batch(schema))


def load_vitals(
    spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping | None = None, *, missing_ok: bool = False
) -> DataFrame:
    """Readings, clean or as the stream appended them (then with ``batch_id`` and ``arrival``)."""
    if fmt == "parquet" and log.state(spark, path).version:
        return load_table(spark, path, schemas.RAW_VITALS)
    return load_table(spark, path, schemas.PATIENT_VITALS, fmt, options, missing_ok=missing_ok)


def load_profiles(spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping | None = None) -> DataFrame:
    """The newest snapshot of the profiles; a table that was never refreshed is read as it is."""
    return load_table(spark, path, schemas.PATIENT_PROFILES, fmt, options)


def load_alerts(spark: SparkSession, root: str) -> DataFrame:
    return load_stream_table(spark, f"{root}/{ALERTS}", schemas.HEALTH_ALERTS)


def load_alerts_by_day(spark: SparkSession, root: str) -> DataFrame:
    return load_stream_table(spark, f"{root}/{ALERTS_BY_DAY}", schemas.HEALTH_ALERTS_BY_DAY)


def patient_bucket(patient: Column, buckets: int = PATIENT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(patient), F.lit(buckets)).cast("int")


def load_alerts_by_patient(
    spark: SparkSession, root: str, patient_id: str | None = None, buckets: int = PATIENT_BUCKETS
) -> DataFrame:
    """Alerts laid out by patient; naming one patient reads only that patient's bucket."""
    alerts = load_stream_table(spark, f"{root}/{ALERTS_BY_PATIENT}", schemas.HEALTH_ALERTS_BY_PATIENT)
    if patient_id is None:
        return alerts
    alerts = alerts.filter(F.col("patient_id") == patient_id)
    if "patient_bucket" in alerts.columns:
        alerts = alerts.filter(F.col("patient_bucket") == patient_bucket(F.lit(patient_id), buckets))
    return alerts


def load_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Messages that could not be stored."""
    return load_stream_table(spark, f"{root}/{QUARANTINE}", schemas.QUARANTINE)


def write_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace exactly the partitions ``df`` has rows for; an empty frame changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_daily_summary(summary: DataFrame, path: str) -> None:
    """Store whole days of the summary; running a day again replaces it."""
    write_partitions(summary, path, "stat_date")


def load_daily_summary(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, schemas.DAILY_HEALTH_SUMMARY, missing_ok=True)


def refresh_profiles(profiles: DataFrame, path: str, based_on: log.State | None = None) -> None:
    """Replace all profiles, by none as well, with the table's next snapshot.

    ``profiles`` may be computed from the table itself: the folder it reads stays in place, so a job that fails
    half-way leaves the table as it was. Given the state they were computed from, ``based_on``, the refresh fails if
    another has come between. Old snapshots go by :func:`wardflow.sources.log.retire`.
    """
    spark = profiles.sparkSession
    rows = profiles.select(*schemas.PATIENT_PROFILES.names)
    log.overwrite(rows, path, based_on or log.state(spark, path), label=SNAPSHOT)


def export_ranking(ranking: DataFrame, path: str) -> None:
    """CSV with a header; part files keep the ranking's order."""
    ranking.write.mode("overwrite").option("header", True).csv(path)
