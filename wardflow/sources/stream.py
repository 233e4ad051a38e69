"""The message stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

ENVELOPE = StructType([StructField("value", BinaryType(), True)])
ARRIVAL = "arrival"
FILE_FORMATS = ("avro", "csv", "json", "orc", "parquet", "text")

# The topic and where a new subscription starts.
KAFKA_DEFAULTS = {
    "kafka.bootstrap.servers": "localhost:9092",
    "subscribe": "patient-vitals",
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
}


def stream_options(fmt: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    return {**(KAFKA_DEFAULTS if fmt == "kafka" else {}), **(options or {})}


def arrival_key(fmt: str | None = None) -> Column:
    """Where a message stands in the order of arrival, as a struct that compares in that order.

    A producer that sends without a key spreads the readings of a patient over all partitions, so neither a
    partition's offsets nor Spark's own order of partitions says which came last: the time the broker or the file
    system recorded does, and only among equal times source and position settle it. A file is one arrival; in it
    the rows follow each other, block by block. Other formats tell nothing but the order in their partitions. Where
    the row is null, :func:`numbered` sets it.
    """
    row = F.lit(None)
    if fmt == "kafka":
        parts = [F.col("timestamp"), F.concat_ws("/", "topic", "partition"), F.lit(0), F.col("offset")]
    elif fmt in FILE_FORMATS:
        parts = [F.col(f"_metadata.file_{name}") for name in ("modification_time", "path", "block_start")] + [row]
    else:
        parts = [F.lit(None), F.lit(None), F.lit(0), row]
    named = zip(parts, ("sent_at", "source", "block", "row"), ("timestamp", "string", "long", "long"))
    return F.struct(*(part.cast(kind).alias(name) for part, name, kind in named))


def numbered(batch: DataFrame) -> DataFrame:
    """``batch``, a micro-batch as it was read, with the row in ``arrival`` set where the source gives none.

    One task reads a block of a file from its start, so in it the numbers are in the order of the rows.
    """
    row = F.coalesce(F.col(f"{ARRIVAL}.row"), F.monotonically_increasing_id())
    return batch.withColumn(ARRIVAL, F.col(ARRIVAL).withField("row", row))


def read_vitals_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    *,
    path: str | None = None,
    schema: StructType = ENVELOPE,
) -> DataFrame:
    """A stream of envelopes whose ``value`` holds one JSON message, with ``arrival``, its place in the order of arrival.

    ``kafka`` needs Spark's connector on the class path. A file format needs ``path``, a folder; it
    may hold messages of another envelope, then named by ``schema``.
    """
    reader = spark.readStream.format(fmt).options(**stream_options(fmt, options))
    envelopes = reader.load() if fmt == "kafka" else reader.schema(schema).load(path)
    return envelopes.withColumn(ARRIVAL, arrival_key(fmt))
