"""Measures of one speed reading, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions import codes
from roadlake.functions.lookup import banded


def event_time(ingested_at: str = "ingested_at") -> Column:
    """Event time of an epoch-millisecond column, cut to whole seconds."""
    return F.timestamp_seconds(F.expr(f"{ingested_at} div 1000"))


def segment_or_query(axis: str) -> Column:
    """Latitude or longitude: the road segment's, else the queried point's."""
    return F.coalesce(F.col(f"segment_{axis}"), F.col(f"query_{axis}"))


def filled_ratio() -> Column:
    """Congestion ratio as double; an unknown one counts as free flow.

    The stored ratio is a float. It is widened before it meets a band, so a stored
    0.95 is 0.949999988079071 and falls below the 0.95 band.
    """
    return F.coalesce(F.col("congestion_ratio").cast("double"), F.lit(1.0))


def speed_ratio(current: Column, free_flow: Column) -> Column:
    """Current over free-flow speed to 3 decimals, half-even; NULL without free flow."""
    return F.bround(F.try_divide(current.cast("double"), free_flow.cast("double")), 3).cast("float")


def speed_drop_pct() -> Column:
    ff = F.col("free_flow_speed_kmh")
    lost = (ff - F.col("current_speed_kmh")) / ff * 100
    return F.when(ff > 0, F.round(lost, 2))


def delay_seconds() -> Column:
    return F.col("current_travel_time") - F.col("free_flow_travel_time")


def delay_minutes() -> Column:
    return F.round(delay_seconds() / F.lit(60.0), 2)


def severity_score(ratio: Column | None = None) -> Column:
    """0 is free flow, 100 a standstill; below 0 when faster than free flow."""
    ratio = filled_ratio() if ratio is None else ratio
    return F.round((F.lit(1.0) - ratio) * 100, 2)


def congestion_level(ratio: Column | None = None) -> Column:
    ratio = filled_ratio() if ratio is None else ratio
    level = banded(ratio, codes.CONGESTION_BANDS, codes.CONGESTION_FLOOR)
    return F.when(F.col("road_closed"), F.lit(codes.CONGESTION_CLOSED)).otherwise(level)


def confidence_band() -> Column:
    return banded(F.col("confidence").cast("double"), codes.CONFIDENCE_BANDS, codes.CONFIDENCE_FLOOR)
