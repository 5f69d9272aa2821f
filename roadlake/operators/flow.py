"""Speed readings: enrichment and the 15-minute rollup. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions import codes, flow, lookup

# Output column -> enriched column, per kind of measure.
AVERAGES = {
    "avg_speed_kmh": "current_speed_kmh",
    "avg_free_flow_kmh": "free_flow_speed_kmh",
    "avg_congestion_ratio": "congestion_ratio",
    "avg_travel_time_seconds": "current_travel_time",
    "avg_free_flow_travel_time_seconds": "free_flow_travel_time",
    "avg_travel_time_delay_seconds": "travel_time_delay_seconds",
    "avg_travel_time_delay_minutes": "travel_time_delay_minutes",
    "avg_speed_drop_pct": "speed_drop_pct",
    "avg_congestion_severity_score": "congestion_severity_score",
    "avg_confidence": "confidence",
}
MINIMA = {"min_speed_kmh": "current_speed_kmh", "min_congestion_ratio": "congestion_ratio"}
MAXIMA = {"max_speed_kmh": "current_speed_kmh", "max_congestion_ratio": "congestion_ratio"}
CARRIED = {
    "frc_code": "frc",
    "congestion_level": "congestion_level",
    "confidence_band": "confidence_band",
    "road_closed_flag": "road_closed",
    "lat": "lat",
    "lon": "lon",
}


def enrich_readings(readings: DataFrame) -> DataFrame:
    """Adds position, event time, labels and congestion measures to each reading."""
    return readings.withColumns(
        {
            "event_time": flow.event_time(),
            "lat": flow.segment_or_query("lat"),
            "lon": flow.segment_or_query("lon"),
            "city": lookup.city_of(F.col("location_name")),
            "frc_label": lookup.road_class_label(F.col("frc")),
            "speed_drop_pct": flow.speed_drop_pct(),
            "travel_time_delay_seconds": flow.delay_seconds(),
            "travel_time_delay_minutes": flow.delay_minutes(),
            "congestion_severity_score": flow.severity_score(),
            "congestion_level": flow.congestion_level(),
            "confidence_band": flow.confidence_band(),
            "congestion_ratio": flow.filled_ratio(),
        }
    )


ROLLUP_COLUMNS = [
    "location_name",
    "city",
    "avg_speed_kmh",
    "min_speed_kmh",
    "max_speed_kmh",
    "avg_free_flow_kmh",
    "avg_congestion_ratio",
    "min_congestion_ratio",
    "max_congestion_ratio",
    "avg_travel_time_seconds",
    "avg_free_flow_travel_time_seconds",
    "avg_travel_time_delay_seconds",
    "avg_travel_time_delay_minutes",
    "avg_speed_drop_pct",
    "avg_congestion_severity_score",
    "avg_confidence",
    "frc_code",
    "frc_label",
    "congestion_level",
    "confidence_band",
    "road_closed_flag",
    "lat",
    "lon",
    "sample_count",
    "window_start",
    "window_end",
]


def average_measures() -> list[Column]:
    return [F.avg(source).alias(name) for name, source in AVERAGES.items()]


def extreme_measures() -> list[Column]:
    return [F.min(s).alias(n) for n, s in MINIMA.items()] + [F.max(s).alias(n) for n, s in MAXIMA.items()]


def carried_measures() -> list[Column]:
    return [lookup.earliest_known(source).alias(name) for name, source in CARRIED.items()]


def count_measure() -> list[Column]:
    return [F.count(F.lit(1)).alias("sample_count")]


def roll_up(enriched: DataFrame, measures: list[Column]) -> DataFrame:
    """Measures per 15-minute window and location, with the location's city.

    On a stream the watermark closes a window 2 minutes of event time after its
    end; on a batch it has no effect. Every measure reduces on the map side, so a
    location with a third of all readings shuffles one row per window and task. The
    city follows from the location, so it is no grouping key.
    """
    return (
        enriched.withWatermark("event_time", codes.WATERMARK)
        .groupBy(F.window("event_time", codes.WINDOW), "location_name")
        .agg(*measures)
        .withColumns(
            {
                "city": lookup.city_of(F.col("location_name")),
                "window_start": F.col("window.start"),
                "window_end": F.col("window.end"),
            }
        )
        .drop("window")
    )


def roll_up_readings(enriched: DataFrame) -> DataFrame:
    """The full rollup. The class label follows from the carried class code."""
    measures = average_measures() + extreme_measures() + carried_measures() + count_measure()
    rolled = roll_up(enriched, measures)
    return rolled.withColumn("frc_label", lookup.road_class_label(F.col("frc_code"))).select(*ROLLUP_COLUMNS)
