"""The nightly compaction job."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake

FAILED = "failed"
OUTCOME = "table_name string, outcome string, rows long"


def previous_day(today: date | None = None) -> dict[str, int]:
    """Partition values of the day before ``today`` (UTC now by default)."""
    target = (today or datetime.now(timezone.utc).date()) - timedelta(days=1)
    return {"year": target.year, "month": target.month, "day": target.day}


def day_predicate(today: date | None = None):
    """The previous day as a predicate on partition columns, so only its folders are listed."""
    return [F.col(name) == value for name, value in previous_day(today).items()]


def compact_previous_day(
    lake: Lake, today: date | None = None, names: list[str] = tables.COMPACTED_TABLES,
    files: int | None = None, keep_seconds: float = 0,
) -> DataFrame:
    """Compacts the partition of the previous day in each table; one outcome row per table.

    A table that fails does not keep the others from being compacted; its row
    tells the error. Replaced files younger than ``keep_seconds`` stay for those who read them.
    """
    day = previous_day(today)
    outcomes = []
    for name in names:
        try:
            outcomes.append(tables.compact(lake, name, day, files, keep_seconds))
        except Exception as error:  # reported as a row, never swallowed
            outcomes.append((name, f"{FAILED}: {error}", 0))
    return lake.spark.createDataFrame(outcomes, OUTCOME)
