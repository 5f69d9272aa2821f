"""Reads of stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet data at a path, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
