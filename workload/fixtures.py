"""Vitals, alerts, profiles and patches derived row by row from the driver's events and customer tables.

No random numbers and no clock; every input row is used. FIXTURES.md describes the shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.functions import columns as col
from wardflow.operators import alerts as al
from wardflow.session import use_utc
from wardflow.sources.stream import ARRIVAL, read_vitals_stream

AS_OF = "2024-01-02 12:00:00"
DAY = "2024-01-02"
BASE_SECONDS = 1704067200  # 2024-01-01 00:00:00 UTC
SQUEEZE = 20  # thirty days of events become 36 hours
RESENT_OFFSET = 10_000_000

# The six metrics take turns; each value is an affine function of k = value / 100 - 0.1.
VITALS_COLUMNS = (
    "event_id",
    # Every 101st reading is that of a patient without a profile.
    "concat('P-', lpad(cast(user_id + CASE event_id % 101 WHEN 100 THEN 900000 ELSE 0 END AS string), 6, '0')) AS patient_id",
    f"""timestamp_seconds({BASE_SECONDS} + cast(floor(
          (unix_timestamp(cast(ts AS timestamp)) - {BASE_SECONDS}) / {SQUEEZE}) AS bigint)) AS timestamp""",
    """CASE event_id % 6 WHEN 0 THEN 'heart_rate' WHEN 1 THEN 'bp_systolic' WHEN 2 THEN 'bp_diastolic'
         WHEN 3 THEN 'spo2' WHEN 4 THEN 'temperature' ELSE 'respiratory_rate' END AS metric_name""",
    """CASE event_id % 6 WHEN 0 THEN 60.0D + 40.0D * k WHEN 1 THEN 110.0D + 20.0D * k
         WHEN 2 THEN 70.0D + 15.0D * k WHEN 3 THEN 100.0D - 5.0D * k
         WHEN 4 THEN 36.5D + 1.5D * k ELSE 12.0D + 6.0D * k END AS value""",
    """CASE event_id % 6 WHEN 1 THEN 'mmHg' WHEN 2 THEN 'mmHg' WHEN 3 THEN '%' WHEN 4 THEN 'C'
         ELSE 'bpm' END AS unit""",
)


def vitals_of(events: DataFrame, *keep: str) -> DataFrame:
    return events.selectExpr("*", "value / 100.0D - 0.1D AS k").selectExpr(*VITALS_COLUMNS, *keep)


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vitals_of(use_utc(spark).read.parquet(f"{sf_dir}/events.parquet"))


def vitals_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vitals, and every 50th reading again: a later arrival with a corrected value."""
    first = vitals(spark, sf_dir)
    again = first.filter(F.col("event_id") % 50 == 0)
    again = again.withColumns({"event_id": F.col("event_id") + RESENT_OFFSET, "value": F.col("value") + 1.0})
    return first.unionByName(again)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts in the state some time later: four kinds of status, as acknowledging them would leave."""
    status = """CASE (event_id div 6) % 10 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'active' WHEN 2 THEN NULL
                ELSE 'ACTIVE' END"""
    found = al.classify_alerts(vitals(spark, sf_dir)).withColumn("status", F.expr(status))
    return al.alerts_by_patient(found)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = use_utc(spark).read.parquet(f"{sf_dir}/customer.parquet")
    return customers.selectExpr(
        "concat('P-', lpad(cast(c_custkey AS string), 6, '0')) AS patient_id",
        "c_name AS name",
        """named_struct('email', concat('c', cast(c_custkey AS string), '@example.com'),
                        'phone', lpad(cast(c_custkey AS string), 10, '0')) AS contact_info""",
        "concat('segment ', c_mktsegment) AS medical_notes",
        "CASE WHEN c_custkey % 11 <> 10 THEN (c_custkey % 11) / 10.0D END AS risk_score",
        "timestamp_ltz'2024-01-01 00:00:00' AS last_updated",
        "cast(NULL AS timestamp) AS risk_score_updated_at",
        "cast(NULL AS string) AS risk_score_source",
    )


def profile_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit forms: one per seventh patient, a second that fails validation for some, and one for nobody."""
    known = profiles(spark, sf_dir)
    number = F.substring("patient_id", 3, 9).cast("int")
    contact = [F.col("contact_info.email").alias("email"), F.lit("0").alias("phone")]
    first = known.filter(number % 7 == 0).select(
        "patient_id",
        F.lit(1).cast("long").alias("seq"),
        F.concat(F.lit("  Patched "), F.col("name"), F.lit(" ")).alias("name"),
        *contact,
        "medical_notes",
    )
    second = known.filter(number % 14 == 0).select(
        "patient_id",
        F.lit(2).cast("long").alias("seq"),
        F.when(number % 28 == 0, F.lit("   ")).otherwise(F.concat(F.lit("Again "), F.col("name"))).alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(" 1 ").alias("phone"),
        F.lit(" later note").alias("medical_notes"),
    )
    nobody = spark.range(1).select(
        F.lit("P-999999").alias("patient_id"),
        F.lit(1).cast("long").alias("seq"),
        F.lit("Nobody").alias("name"),
        F.lit("n@example.com").alias("email"),
        F.lit("0").alias("phone"),
        F.lit("unknown patient: must not be inserted").alias("medical_notes"),
    )
    return first.unionByName(second).unionByName(nobody)


def messages_of(events: DataFrame) -> DataFrame:
    """Each event as the JSON message a device would send; some are damaged in one of three ways.

    A stream's messages keep their place in the order of arrival.
    """
    arrival = [c for c in events.columns if c == ARRIVAL]
    rows = vitals_of(events, *arrival).withColumn("timestamp", col.time_text(F.col("timestamp")))
    turn = F.col("event_id") % 97
    text = F.to_json(
        F.struct(
            F.when(turn != 1, F.col("patient_id")).alias("patient_id"),
            "metric_name",
            "value",
            "unit",
            F.when(turn == 2, F.lit("not a time")).otherwise(F.col("timestamp")).alias("timestamp"),
        )
    )
    damaged = F.when(turn == 3, F.substring(text, 1, 20)).otherwise(text)
    return rows.select("event_id", *arrival, damaged.cast("binary").alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(use_utc(spark).read.parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; a file stream needs the folder and a file pattern."""
    schema = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet").schema
    return read_vitals_stream(spark, "parquet", {"pathGlobFilter": "events.parquet"}, path=sf_dir, schema=schema)
