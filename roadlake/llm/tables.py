"""Input tables and intermediate tables of this package."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.session import configure, fresh_folder


# Texts per Arrow batch: even the longest texts then fit a Python worker side by side.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here and
    a lost executor costs only a re-read."""
    path = fresh_folder(rows.sparkSession, f"llm-{purpose}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def column(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(rows: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the rows has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


BLOOM_BITS = 25


def sieve(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that passes every one of the keys and nearly no other value, to thin out rows
    before a join shuffles them. It is a bitmap of 2^BLOOM_BITS bits (4 MB) whatever the
    number of keys; with very many keys it passes more, never too few."""
    page = 15
    bit = lambda c: F.shiftrightunsigned(F.xxhash64(c.cast("bigint")), 64 - BLOOM_BITS)
    bits = keys.select(bit(F.col(key)).alias("bit"))
    pages = bits.groupBy(F.shiftright("bit", page).alias("page")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND((1 << page) - 1)).alias("bits")
    )
    bitmap = np.zeros((1 << BLOOM_BITS) // 8, np.uint8)
    for row in pages.collect():
        at = row.page << (page - 3)
        bitmap[at : at + (1 << (page - 3))] = np.frombuffer(row.bits, np.uint8)

    def passes(bits: pa.Array) -> pa.Array:
        b = bits.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((bitmap[b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1)

    test = arrow_udf(passes, T.BooleanType())
    return lambda c: test(bit(c))
