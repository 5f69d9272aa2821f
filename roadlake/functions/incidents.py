"""Measures of one incident report, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions import codes


def parsed_time(text: str) -> Column:
    """ISO text to timestamp; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(F.col(text))


def both_known(start: Column, end: Column) -> Column:
    return start.isNotNull() & end.isNotNull()


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes from start to end, NULL unless both are known; may be negative."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.when(both_known(start, end), F.round(seconds / F.lit(60.0), 2))


def delay_minutes() -> Column:
    return F.round(F.col("delay_seconds") / F.lit(60.0), 2)


def length_km() -> Column:
    return F.round(F.col("length_meters") / F.lit(1000.0), 3)


def is_road_closure() -> Column:
    return F.lower(F.col("category")) == F.lit(codes.CLOSURE_CATEGORY)


def has_known_location() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull()


def is_active(at: Column, start: Column, end: Column) -> Column:
    """Whether the report falls in [start, end]; true when either end is unknown."""
    return F.when(both_known(start, end), at.between(start, end)).otherwise(F.lit(True))
