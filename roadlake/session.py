"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # All windows, days and slots are UTC, whatever zone the host is in.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed ones
    # (joins and rebalanced writes) and switches to broadcast on measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Scan tasks of few stored bytes: records are many times as large where they are hashed by
    # wide values, and what one task hashes must fit its memory. Small files still share a task.
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.files.openCostInBytes": "1m",
}

# Settings a session has to be started with.
STARTUP_CONF = {
    # Recording the Python line of every column costs a call into the JVM each time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Settings a long-running streaming deployment should also start with.
STREAMING_CONF = {
    # Window state grows with locations; keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """What a query that keeps state is started with (it copies the session's settings as it starts).

    Every batch writes one file a state partition, so there are no more of them than cores, and
    the heap holds the state of one batch, not that of the one before as well.
    """
    cores, named = spark.sparkContext.defaultParallelism, "spark.sql.shuffle.partitions"
    settings = {
        named: str(min(int(spark.conf.get(named)), cores)),
        "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: what the cluster names in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder; on a
    cluster a machine-local folder would not survive an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="roadlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
