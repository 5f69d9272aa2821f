"""Record streams: a replayed folder of files, or a broker topic."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def dated_in_order(spark: SparkSession, folder: str) -> bool:
    """Dates the files one write left in a folder a second apart, in the order of its tasks and
    of the files of each, so that a replay takes them in that order. False if the store keeps no such dates."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def written() -> list:
        found = [(re.match(r"part-(\d+)-.*-c(\d+)\.", s.getPath().getName()), s) for s in store.listStatus(path)]
        return [s for _, s in sorted(((int(m[1]), int(m[2])), s) for m, s in found if m)]

    last = max((s.getModificationTime() for s in written()), default=0) // 1000
    for back, status in enumerate(reversed(written())):
        store.setTimes(status.getPath(), (last - back) * 1000, -1)
    dates = [s.getModificationTime() for s in written()]
    return all(a < b for a, b in zip(dates, dates[1:]))


def replay_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None, kind: str = "parquet",
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the files in a folder, oldest first; ``files_per_trigger`` or ``bytes_per_trigger`` caps a batch."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(folder)


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None, starting: str = "latest",
    fail_on_loss: bool = True,
) -> DataFrame:
    """Stream of a broker topic with key, value and timestamp.

    Needs the external broker connector on the cluster. All that is there is taken, unless
    ``max_records`` caps a trigger; a cap below the rate of arrival outlives the topic's
    retention, which stops the query rather than skip records (``fail_on_loss``).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    try:
        return reader.load()
    except AnalysisException as missing:
        raise RuntimeError("the broker connector package is not on this cluster") from missing
