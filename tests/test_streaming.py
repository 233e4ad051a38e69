"""The ingest stream: restart, replay, deduplication, quarantine, and equality with the batch operators."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wardflow import schemas
from wardflow.operators import alerts as al, ingest
from wardflow.session import ROCKSDB_STATE
from wardflow.sources import tables
from wardflow.sources.stream import KAFKA_DEFAULTS, read_vitals_stream, stream_options
from wardflow.streaming.ingest import compact_vitals, start_vitals_stream, write_micro_batch

NOW = {"availableNow": True}
STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
START = datetime(2024, 1, 2, 11, 0, 0)


def message(patient, second, value, metric="heart_rate", **changes):
    body = {"patient_id": patient, "metric_name": metric, "value": value, "unit": "bpm",
            "timestamp": (START + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S")}
    return json.dumps({**body, **changes})


class Feed:
    """A folder of text files; each file is picked up as messages with a ``value`` column."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        path.mkdir()

    def send(self, *messages):
        self.n += 1
        file = self.path / f"{self.n:03d}.txt"
        file.write_text("\n".join(messages) + "\n")
        os.utime(file, (1704200000 + self.n, 1704200000 + self.n))  # files are read in order of their age

    def stream(self, **options):
        return read_vitals_stream(self.spark, "text", options, path=str(self.path), schema="value string")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def run(feed, root, options=None, **kwargs):
    query = start_vitals_stream(feed.stream(**(options or {})), root, trigger=NOW, **kwargs)
    query.awaitTermination()
    return query


def stored(spark, root, table, schema):
    return tables.load_table(spark, f"{root}/{table}", schema).select(*schema.names)


def test_all_tables_and_restart(spark, feed, tmp_path):
    root = str(tmp_path / "root")
    feed.send(message("a", 0, 130.0), message("a", 1, 80.0), message("b", 2, None), "broken", message("c", 3, 130.0, timestamp="soon"))
    run(feed, root)
    vitals = stored(spark, root, tables.VITALS, schemas.PATIENT_VITALS)
    assert sorted((r.patient_id, r.value) for r in vitals.collect()) == [("a", 80.0), ("a", 130.0), ("b", None)]
    expected = al.classify_alerts(vitals)
    for table, schema, project in (
        (tables.ALERTS, schemas.HEALTH_ALERTS, al.alerts_base),
        (tables.ALERTS_BY_DAY, schemas.HEALTH_ALERTS_BY_DAY, al.alerts_by_day),
        (tables.ALERTS_BY_PATIENT, schemas.HEALTH_ALERTS_BY_PATIENT, al.alerts_by_patient),
    ):
        assert stored(spark, root, table, schema).collect() == project(expected).collect()
    rejects = spark.read.parquet(f"{root}/{tables.QUARANTINE}").collect()
    assert sorted(json.loads(r.raw_message)["patient_id"] if r.raw_message != "broken" else "" for r in rejects) == ["", "c"]

    # nothing new: a restart from the checkpoint adds no rows
    run(feed, root)
    assert vitals.sparkSession.read.parquet(f"{root}/{tables.VITALS}").count() == 3
    # late readings are accepted and join their own day
    feed.send(message("a", -3 * 86400, 70.0))
    run(feed, root)
    days = spark.read.parquet(f"{root}/{tables.VITALS}").groupBy("day").count().collect()
    assert sorted((str(r.day), r["count"]) for r in days) == [("2023-12-30", 1), ("2024-01-02", 3)]


def test_replayed_batch_leaves_the_tables_unchanged(spark, tmp_path):
    root = str(tmp_path / "root")
    texts = [message("a", i, 100.0 + i) for i in range(40)] + ["broken"]
    envelopes = spark.createDataFrame([(t,) for t in texts], "value string")
    batch = ingest.decode_vitals(envelopes, raw_as="raw_message")

    def counts():
        names = (tables.VITALS, tables.ALERTS, tables.ALERTS_BY_DAY, tables.ALERTS_BY_PATIENT, tables.QUARANTINE)
        return [spark.read.parquet(f"{root}/{t}").count() for t in names]

    write_micro_batch(batch, 0, root)
    assert counts() == [40, 19, 19, 19, 1]
    write_micro_batch(batch, 0, root)
    assert counts() == [40, 19, 19, 19, 1]
    write_micro_batch(batch, 1, root)
    assert counts() == [80, 38, 38, 38, 2]


@pytest.mark.parametrize("provider", [None, ROCKSDB_STATE])
def test_resent_readings_are_dropped_within_the_delay(spark, feed, tmp_path, provider):
    root = str(tmp_path / "root")
    if provider:
        spark.conf.set(STATE_CONF, provider)
    feed.send(message("a", 0, 80.0), message("a", 0, 80.0), message("b", 0, 81.0), "broken", "broken")
    feed.send(message("a", 0, 99.0), message("a", 60, 82.0), message("b", 0, 81.0))
    try:
        run(feed, root, {"maxFilesPerTrigger": "1"}, dedup_delay="1 hour")
    finally:
        spark.conf.unset(STATE_CONF)
    vitals = stored(spark, root, tables.VITALS, schemas.PATIENT_VITALS)
    assert sorted((r.patient_id, r.value) for r in vitals.collect()) == [("a", 80.0), ("a", 82.0), ("b", 81.0)]
    assert spark.read.parquet(f"{root}/{tables.QUARANTINE}").count() == 2


def test_compaction_keeps_the_last_batch(spark, feed, tmp_path):
    root = str(tmp_path / "root")
    feed.send(message("a", 0, 80.0), message("a", 5, 81.0), message("a", 86400, 70.0))
    feed.send(message("a", 0, 95.0))
    run(feed, root, {"maxFilesPerTrigger": "1"})
    compact_vitals(spark, root, "2024-01-02")
    clean = stored(spark, root, tables.VITALS_CLEAN, schemas.PATIENT_VITALS)
    assert sorted(r.value for r in clean.collect()) == [81.0, 95.0]
    compact_vitals(spark, root)
    compact_vitals(spark, root)
    assert sorted(r.value for r in clean.sparkSession.read.parquet(f"{root}/{tables.VITALS_CLEAN}").collect()) == [70.0, 81.0, 95.0]


def test_compaction_without_input(spark, tmp_path):
    compact_vitals(spark, str(tmp_path / "nothing"))
    assert not (tmp_path / "nothing").exists()


def test_alerts_of_one_patient_read_one_bucket(spark, feed, tmp_path):
    root = str(tmp_path / "root")
    feed.send(*[message(f"p{i}", i, 130.0) for i in range(60)])
    run(feed, root)
    one = tables.load_alerts_by_patient(spark, root, "p7")
    assert [r.patient_id for r in one.collect()] == ["p7"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(patient_bucket" in plan.replace("\n", " ")
    assert tables.load_alerts_by_patient(spark, root).count() == 60


def test_a_failing_batch_ends_the_query(spark, feed, tmp_path):
    feed.send(message("a", 0, 130.0))
    (tmp_path / "blocked").write_text("a file where the tables should go")
    query = start_vitals_stream(feed.stream(), str(tmp_path / "blocked"), trigger=NOW, checkpoint=str(tmp_path / "cp"))
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_envelope_columns_can_be_kept(spark):
    df = spark.createDataFrame([(message("a", 0, 1.0), 17)], "value string, offset long")
    row = ingest.decode_vitals(df, keep=("offset",)).first()
    assert (row.offset, row.patient_id) == (17, "a")


def test_kafka_options():
    assert stream_options("kafka") == KAFKA_DEFAULTS
    merged = stream_options("kafka", {"subscribe": "other", "maxOffsetsPerTrigger": "1000"})
    assert merged["subscribe"] == "other" and merged["startingOffsets"] == "latest"
    assert stream_options("parquet", {"a": "b"}) == {"a": "b"}


def test_dedup_stream_needs_no_more_than_the_key(spark):
    df = spark.createDataFrame([("a", START, "spo2", 1.0), ("a", START, "spo2", 2.0)], "patient_id string, timestamp timestamp, metric_name string, value double")
    assert df.isStreaming is False
    assert ingest.dedup_latest(df.withColumn("n", F.col("value")), "n").first().value == 2.0


def test_the_later_message_wins_from_whatever_partition(spark, feed, tmp_path):
    """Messages without a key: the correction is sent later, to the partition that Spark numbers first."""
    root = str(tmp_path / "root")
    feed.send(message("a", 0, 80.0), message("b", 0, 1.0), message("b", 0, 2.0), message("b", 0, 3.0))
    feed.send(message("a", 0, 150.0, note="x" * 5000))
    # the file named and listed first is the younger one
    os.utime(feed.path / "001.txt", (1704300000, 1704300000))
    run(feed, root)
    raw = tables.load_vitals(spark, f"{root}/{tables.VITALS}")
    order = [r.value for r in raw.filter("patient_id = 'a'").orderBy("arrival").collect()]
    assert order == [150.0, 80.0]
    assert {r.patient_id: r.value for r in ingest.current_rows(raw).collect()} == {"a": 80.0, "b": 3.0}
    (where,) = raw.filter("value = 80").select("arrival.*").collect()
    assert where.source.endswith("001.txt") and where.sent_at.timestamp() == 1704300000


def test_kafka_order_of_arrival(spark):
    from wardflow.sources.stream import arrival_key

    records = [("t", 1, 7, START, 80.0), ("t", 0, 99, START - timedelta(seconds=1), 150.0), ("t", 1, 8, START, 81.0)]
    df = spark.createDataFrame(records, "topic string, partition int, offset long, timestamp timestamp, v double")
    ordered = df.select("v", arrival_key("kafka").alias("arrival")).orderBy("arrival").collect()
    assert [r.v for r in ordered] == [150.0, 80.0, 81.0]
    assert ordered[0].arrival.asDict() == {"sent_at": START - timedelta(seconds=1), "source": "t/0", "block": 0, "row": 99}


def test_deduplication_reads_its_source_once(spark, feed, tmp_path):
    root = str(tmp_path / "root")
    feed.send(message("a", 0, 80.0), "broken", "broken", message("b", 0, 1.0, timestamp="soon"))
    feed.send(message("a", 0, 80.0), "broken", message("a", 5, 81.0))
    feed.send(message("a", 7200, 82.0), message("a", 5, 81.0), "broken")
    query = run(feed, root, {"maxFilesPerTrigger": "1"}, dedup_delay="1 hour")
    assert len(query.lastProgress.sources) == 1
    assert query.exception() is None
    vitals = stored(spark, root, tables.VITALS, schemas.PATIENT_VITALS)
    assert sorted(r.value for r in vitals.collect()) == [80.0, 81.0, 82.0]
    assert tables.load_quarantine(spark, root).count() == 5
    # the state of rejects goes with the watermark
    feed.send(message("a", 14400, 83.0))
    feed.send(message("a", 14401, 84.0))
    query = run(feed, root, {"maxFilesPerTrigger": "1"}, dedup_delay="1 hour")
    assert query.lastProgress.stateOperators[0].numRowsTotal == 2


def test_a_new_checkpoint_adds_to_the_tables(spark, feed, tmp_path):
    root = str(tmp_path / "root")
    feed.send(message("a", 0, 80.0))
    run(feed, root, checkpoint=str(tmp_path / "one"))
    run(feed, root, checkpoint=str(tmp_path / "one"))
    assert tables.load_vitals(spark, f"{root}/{tables.VITALS}").count() == 1
    run(feed, root, checkpoint=str(tmp_path / "two"))
    raw = tables.load_vitals(spark, f"{root}/{tables.VITALS}")
    assert raw.count() == 2 and ingest.current_rows(raw).count() == 1
