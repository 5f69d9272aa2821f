"""Surrogate keys of rollup rows: joins with the dimensions, and the fact rows.

All joins are left joins on plain equality, so a row without a member (or with a
NULL key) keeps a NULL surrogate key. No join is hinted: Spark broadcasts a
dimension when its measured size is under the broadcast threshold and otherwise
shuffles both sides, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions import calendar
from roadlake.sources.dimensions import Dimensions

# The column names of the two fact tables.
FLOW_FACT_COLUMNS = [
    "date_key", "time_key", "location_sk",
    "window_start_utc", "window_end_utc",
    "frc_code", "frc_label",
    "avg_speed_kmh", "min_speed_kmh", "max_speed_kmh", "avg_free_flow_kmh",
    "avg_congestion_ratio", "min_congestion_ratio", "max_congestion_ratio", "avg_congestion_severity_score",
    "avg_travel_time_seconds", "avg_free_flow_travel_time_seconds",
    "avg_travel_time_delay_seconds", "avg_travel_time_delay_minutes",
    "avg_speed_drop_pct",
    "congestion_level", "road_closed_flag", "avg_confidence", "confidence_band",
    "sample_count",
]

INCIDENT_FACT_COLUMNS = [
    "date_key", "time_key", "location_sk", "category_sk",
    "window_start_utc", "incident_start_utc", "incident_end_utc", "incident_duration_minutes",
    "from_location", "to_location", "road_numbers", "lat", "lon", "has_known_location",
    "magnitude", "magnitude_label", "delay_seconds", "delay_minutes", "length_meters", "length_km",
    "is_road_closure", "is_active_at_ingestion",
]

# What identifies a fact row; kept in the fact tables so that a reload replaces it.
FLOW_IDENTITY = ["window_start_utc", "location_name"]
INCIDENT_IDENTITY = [
    "window_start_utc", "bbox_name", "category", "from_location", "to_location", "incident_start_utc",
]


# Days outside are taken for wrong clocks; their rows are rejected whole.
PLAUSIBLE_DAYS = ("2000-01-01", "2099-12-31")


def with_days_to_come(facts: DataFrame, at: str) -> DataFrame:
    """Gives plausible days that the calendar lacks so far the key it will have for them."""
    day = F.to_date(at)
    plausible = day.between(*[F.lit(d).cast("date") for d in PLAUSIBLE_DAYS])
    return facts.withColumn("date_key", F.coalesce("date_key", F.when(plausible, calendar.date_key(day))))


def with_date_key(rows: DataFrame, date: DataFrame, at: str) -> DataFrame:
    day = date.select("date_key", F.col("full_date").alias("_day"))
    return rows.join(day, F.to_date(rows[at]) == day["_day"], "left").drop("_day")


def with_time_key(rows: DataFrame, at: str) -> DataFrame:
    """Key of the slot a time falls in. All 96 slots exist, so no join is needed."""
    return rows.withColumn("time_key", calendar.slot_of(F.col(at)))


def with_location_key(rows: DataFrame, location: DataFrame, place: str) -> DataFrame:
    """Needs current versions only, or every version would match."""
    current = location.select("location_sk", F.col("location_key").alias("_place"))
    return rows.join(current, rows[place] == current["_place"], "left").drop("_place")


def with_category_key(rows: DataFrame, category: DataFrame) -> DataFrame:
    raw = category.select("category_sk", "category_raw")
    return rows.join(raw, rows["category"] == raw["category_raw"], "left").drop("category_raw")


def resolve_flow_keys(rollup: DataFrame, dims: Dimensions) -> DataFrame:
    dims = dims.lookups()
    keyed = with_time_key(with_date_key(rollup, dims.date, "window_start"), "window_start")
    return with_location_key(keyed, dims.location, "location_name")


def resolve_incident_keys(collapsed: DataFrame, dims: Dimensions) -> DataFrame:
    dims = dims.lookups()
    keyed = with_time_key(with_date_key(collapsed, dims.date, "event_time"), "event_time")
    return with_category_key(with_location_key(keyed, dims.location, "bbox_name"), dims.category)


def flow_facts(keyed: DataFrame, *keep: str) -> DataFrame:
    renamed = keyed.withColumnsRenamed({"window_start": "window_start_utc", "window_end": "window_end_utc"})
    return renamed.select(*FLOW_FACT_COLUMNS, *keep)


def incident_facts(keyed: DataFrame, *keep: str) -> DataFrame:
    renamed = keyed.withColumnsRenamed(
        {
            "event_time": "window_start_utc",
            "start_time_parsed": "incident_start_utc",
            "end_time_parsed": "incident_end_utc",
            "is_active": "is_active_at_ingestion",
        }
    )
    return renamed.select(*INCIDENT_FACT_COLUMNS, *keep)


def in_calendar(facts: DataFrame) -> DataFrame:
    return facts.where("date_key IS NOT NULL")


def outside_calendar(facts: DataFrame) -> DataFrame:
    """Dead-letter rows, the whole record each, for facts whose day no calendar can hold."""
    return facts.where("date_key IS NULL").select(
        F.current_timestamp().alias("failed_at"),
        F.lit("day outside the calendar").alias("reason"),
        F.to_json(F.struct("*")).alias("record"),
    )
