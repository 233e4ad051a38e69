"""One query: read and decode the messages once, write the vitals, the alert layouts and the rejects."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow import schemas
from wardflow.operators import alerts as al, ingest
from wardflow.sources import log, tables
from wardflow.sources.stream import ARRIVAL, arrival_key, numbered

RAW = "raw_message"


def gathered(found: DataFrame, *partitions: str) -> DataFrame:
    """Rows brought together for a partitioned write, by their bytes: small partitions make few files.

    Without this every task would add a small file to every bucket. Adaptive execution joins small parts and
    splits a large one, such as a hot patient's bucket, so the number of tasks follows the data.
    """
    return found.hint("rebalance", *partitions)


def write_micro_batch(
    batch: DataFrame, batch_id: int, root: str, *, buckets: int = tables.PATIENT_BUCKETS, stream: str = ""
) -> None:
    """Write one decoded micro-batch to all tables.

    Each table takes the batch with one commit and remembers it, so a batch that is replayed after a failure reaches
    only the tables that have not got it. The vitals are not shuffled. ``arrival`` says which of two readings of a
    key in a batch is the later one, whatever partitions they came in.
    """
    if ARRIVAL not in batch.columns:
        batch = batch.withColumn(ARRIVAL, arrival_key())
    batch = numbered(batch)
    held = batch.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).persist(StorageLevel.MEMORY_AND_DISK)

    def append(rows: DataFrame, table: str, *partitions: str) -> None:
        log.append(rows, f"{root}/{table}", *partitions, stream=stream, batch=int(batch_id))

    try:
        good, bad = ingest.split_bad_records(held)
        append(good.select(*schemas.RAW_VITALS.names, F.to_date("timestamp").alias("day")), tables.VITALS, "day")

        found = al.classify_alerts(good)
        append(gathered(found.select(*schemas.HEALTH_ALERTS.names, "batch_id")), tables.ALERTS)
        by_day = found.select(*schemas.HEALTH_ALERTS_BY_DAY.names, "batch_id")
        append(gathered(by_day, "day"), tables.ALERTS_BY_DAY, "day")
        bucket = tables.patient_bucket(F.col("patient_id"), buckets).alias("patient_bucket")
        by_patient = found.select(*schemas.HEALTH_ALERTS_BY_PATIENT.names, bucket, "batch_id")
        append(gathered(by_patient, "patient_bucket"), tables.ALERTS_BY_PATIENT, "patient_bucket")

        append(bad.select(RAW, "batch_id"), tables.QUARANTINE)
    finally:
        held.unpersist()


def decoded_stream(envelopes: DataFrame, *, dedup_delay: str | None = None) -> DataFrame:
    """Decoded messages with their text; re-sent readings are dropped when ``dedup_delay`` is given.

    Without it there is no watermark and late readings are accepted into their own day.
    """
    keep = [ARRIVAL] if ARRIVAL in envelopes.columns else []
    decoded = ingest.decode_vitals(envelopes, keep=keep, raw_as=RAW)
    return decoded if dedup_delay is None else ingest.dedup_messages(decoded, dedup_delay)


def start_vitals_stream(
    envelopes: DataFrame,
    root: str,
    *,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    dedup_delay: str | None = None,
    buckets: int = tables.PATIENT_BUCKETS,
) -> StreamingQuery:
    """Start the ingest query; the caller awaits it, and its failure ends that wait.

    ``trigger`` is passed on (``{"availableNow": True}``); none means a batch after the other. A query with another
    checkpoint counts its batches anew; the tables tell them apart by the query's id and add them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_micro_batch(batch, batch_id, root, buckets=buckets, stream=query or "")

    stream = decoded_stream(envelopes, dedup_delay=dedup_delay)
    where = checkpoint or f"{root}/_checkpoint"
    writer = stream.writeStream.option("checkpointLocation", where).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def compact_vitals(spark: SparkSession, root: str, *days: str) -> None:
    """Fold the ingest batches of some days into one clean row per reading.

    The last batch wins, and in a batch the last arrival. Files are laid out by range of patient and time, which splits a hot patient
    over several files and lets a read of one patient skip the others by their statistics.
    """
    vitals = tables.load_vitals(spark, f"{root}/{tables.VITALS}", missing_ok=True)
    if "batch_id" not in vitals.columns:
        return
    if days:
        vitals = vitals.filter(F.col("day").isin(*[F.lit(d).cast("date") for d in days]))
    clean = _by_patient(ingest.current_rows(vitals).select(*schemas.PATIENT_VITALS.names, "day"))
    tables.write_partitions(clean, f"{root}/{tables.VITALS_CLEAN}", "day")


def _by_patient(vitals: DataFrame) -> DataFrame:
    ranged = vitals.repartitionByRange("day", "patient_id", "timestamp")
    return ranged.sortWithinPartitions("day", "patient_id", F.col("timestamp").desc(), "metric_name")


def compact_batches(spark: SparkSession, root: str, *, fan: int = 10, keep: int = 2) -> dict[str, int]:
    """Fold the many small folders that the stream's batches leave into few, table by table; how many folds each took.

    Every ``fan`` folders of a size become one of the next, so a row is written again once per power of ``fan``.
    A reading that was sent again and an alert that was found again are kept once, the last one. Readers see the old
    folders or the new ones; the old leave the disk when ``keep`` later states are there.
    """
    alert_keys = ["alert_id"]
    plans = {
        tables.VITALS: (
            schemas.RAW_VITALS, ["day"], lambda rows: _by_patient(ingest.dedup_latest(rows, ["batch_id", ARRIVAL])),
        ),
        tables.ALERTS: (
            schemas.with_batch(schemas.HEALTH_ALERTS), [],
            lambda rows: gathered(ingest.dedup_latest(rows, "batch_id", alert_keys)),
        ),
        tables.ALERTS_BY_DAY: (
            schemas.with_batch(schemas.HEALTH_ALERTS_BY_DAY), ["day"],
            lambda rows: gathered(ingest.dedup_latest(rows, "batch_id", alert_keys), "day"),
        ),
        tables.ALERTS_BY_PATIENT: (
            schemas.with_batch(schemas.HEALTH_ALERTS_BY_PATIENT), ["patient_bucket"],
            lambda rows: gathered(ingest.dedup_latest(rows, "batch_id", alert_keys), "patient_bucket"),
        ),
        tables.QUARANTINE: (schemas.with_batch(schemas.QUARANTINE), [], gathered),
    }
    folds = {}
    for table, (schema, partitions, rewrite) in plans.items():
        path = f"{root}/{table}"
        folds[table] = log.compact(spark, path, schema, rewrite, *partitions, fan=fan)
        log.retire(spark, path, keep)
    return folds
