"""Session settings the operators rely on, and where scratch tables may go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Keeps the state of the streaming deduplication on disk rather than on the executors' heap.
ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_utc(spark: SparkSession) -> SparkSession:
    """All dates, lookbacks and rendered times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_session(app_name: str = "wardflow") -> SparkSession:
    """The session a job runs in; master, memory and shuffle width come from spark-submit."""
    return use_utc(
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the Python line of every column expression takes longer than planning them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master without that setting (a test run) falls back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    return tempfile.mkdtemp(prefix="wardflow-")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`shared_dir` for one run's tables."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a directory that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
