"""Declared schemas of every table; nothing is inferred."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields])


# The JSON message; its timestamp is text such as 2024-01-02 03:04:05.
MESSAGE = _struct(
    ("patient_id", StringType),
    ("metric_name", StringType),
    ("value", DoubleType),
    ("unit", StringType),
    ("timestamp", StringType),
)

PATIENT_VITALS = _struct(
    ("patient_id", StringType),
    ("timestamp", TimestampType),
    ("metric_name", StringType),
    ("value", DoubleType),
    ("unit", StringType),
)

# A message's place in the order of arrival (see wardflow.sources.stream.arrival_key).
ARRIVAL = _struct(("sent_at", TimestampType), ("source", StringType), ("block", LongType), ("row", LongType))

QUARANTINE = _struct(("raw_message", StringType))


def with_batch(schema: StructType) -> StructType:
    """The columns of a table as the stream stores it, batch by batch."""
    return StructType([*schema.fields, StructField("batch_id", LongType(), True)])


RAW_VITALS = with_batch(StructType([*PATIENT_VITALS.fields, StructField("arrival", ARRIVAL, True)]))

HEALTH_ALERTS = _struct(
    ("alert_id", StringType),
    ("patient_id", StringType),
    ("metric_name", StringType),
    ("observed_value", DoubleType),
    ("alert_type", StringType),
    ("timestamp", TimestampType),
    ("status", StringType),
)

HEALTH_ALERTS_BY_DAY = _struct(
    ("day", DateType),
    ("timestamp", TimestampType),
    ("alert_id", StringType),
    ("patient_id", StringType),
    ("metric_name", StringType),
    ("observed_value", DoubleType),
    ("alert_type", StringType),
    ("status", StringType),
)

HEALTH_ALERTS_BY_PATIENT = _struct(
    ("patient_id", StringType),
    ("timestamp", TimestampType),
    ("alert_id", StringType),
    ("metric_name", StringType),
    ("observed_value", DoubleType),
    ("alert_type", StringType),
    ("status", StringType),
    ("day", DateType),
)

DAILY_HEALTH_SUMMARY = _struct(
    ("stat_date", DateType),
    ("metric_name", StringType),
    ("avg_value", DoubleType),
    ("min_value", DoubleType),
    ("max_value", DoubleType),
    ("patient_count", IntegerType),
)

# What daily summaries are kept up to date from; partitioned by day.
SUMMARY_STATE = _struct(
    ("metric_name", StringType),
    ("patient_id", StringType),
    ("readings", LongType),
    ("total", DoubleType),
    ("low", DoubleType),
    ("high", DoubleType),
    ("day", DateType),
)

CONTACT_INFO = _struct(("email", StringType), ("phone", StringType))

PATIENT_PROFILES = StructType(
    [
        StructField("patient_id", StringType(), True),
        StructField("name", StringType(), True),
        StructField("contact_info", CONTACT_INFO, True),
        StructField("medical_notes", StringType(), True),
        StructField("risk_score", DoubleType(), True),
        StructField("last_updated", TimestampType(), True),
        StructField("risk_score_updated_at", TimestampType(), True),
        StructField("risk_score_source", StringType(), True),
    ]
)

VITALS_KEY = ("patient_id", "timestamp", "metric_name")
