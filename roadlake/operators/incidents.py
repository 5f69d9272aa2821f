"""Incident reports: enrichment and the collapse of repeated polls. Batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions import codes, flow, incidents, lookup

IDENTITY = ["bbox_name", "category", "from_location", "to_location", "start_time_parsed"]

# Values carried from the earliest poll that knows them: those that fit a packed number, and
# texts, times and positions, which polls of one incident seldom change.
CARRIED_NARROW = [
    "icon_category_id",
    "magnitude",
    "delay_seconds",
    "length_meters",
    "has_known_location",
    "is_active",
]
CARRIED_WIDE = ["road_numbers", "end_time_parsed", "lat", "lon"]

COLLAPSED_COLUMNS = IDENTITY + [
    "city",
    "icon_category_id",
    "magnitude",
    "magnitude_label",
    "delay_seconds",
    "delay_minutes",
    "length_meters",
    "length_km",
    "road_numbers",
    "end_time_parsed",
    "incident_duration_minutes",
    "is_road_closure",
    "has_known_location",
    "is_active",
    "lat",
    "lon",
    "event_time",
]


def measures() -> dict[str, Column]:
    """Columns that follow from an incident's own values, so from a poll or a collapsed row alike."""
    return {
        "city": lookup.city_of(F.col("bbox_name")),
        "incident_duration_minutes": incidents.duration_minutes(F.col("start_time_parsed"), F.col("end_time_parsed")),
        "delay_minutes": incidents.delay_minutes(),
        "length_km": incidents.length_km(),
        "magnitude_label": lookup.magnitude_label(F.col("magnitude")),
        "is_road_closure": incidents.is_road_closure(),
    }


def time_reports(reports: DataFrame) -> DataFrame:
    """Event time, parsed times and the two flags only a single poll can tell."""
    timed = reports.withColumns(
        {
            "event_time": flow.event_time(),
            "start_time_parsed": incidents.parsed_time("start_time"),
            "end_time_parsed": incidents.parsed_time("end_time"),
        }
    ).drop("ingested_at", "start_time", "end_time")
    return timed.withColumns(
        {
            "has_known_location": incidents.has_known_location(),
            "is_active": incidents.is_active(
                F.col("event_time"), F.col("start_time_parsed"), F.col("end_time_parsed")
            ),
        }
    )


def enrich_incidents(reports: DataFrame) -> DataFrame:
    """Adds event time, parsed times, measures and flags; drops the raw time columns."""
    return time_reports(reports).withColumns(measures())


def collapse_polls(reports: DataFrame) -> DataFrame:
    """One row per incident identity and 15-minute window; takes raw or enriched reports.

    NULL identity parts group together. Each carried value is the earliest known one
    on its own, so a NULL in the first poll is filled by a later poll. Measures are
    computed once per collapsed row, not once per poll.

    Polls are first grouped by their wide values too, which leaves only numbers to
    aggregate: Spark hashes all polls, on the map side already, and sorts just the few
    rows that an incident has left. On a stream one step does it all: the state of a second
    one would be written, kept and dropped again, which is dearer than sorting the polls. That
    is by a hash of the keys first, which Spark compares as a number, and by the keys where hashes are equal.
    """
    timed = reports if "start_time_parsed" in reports.columns else time_reports(reports)
    types = {name: timed.schema[name].dataType for name in CARRIED_NARROW}
    timed = timed.withWatermark("event_time", codes.WATERMARK)
    window, numbers, seen = F.window("event_time", codes.WINDOW), {n: lookup.packed(n) for n in CARRIED_NARROW}, "event_time"
    if not timed.isStreaming:
        timed = timed.groupBy(window, *IDENTITY, *CARRIED_WIDE).agg(
            F.min("event_time").alias("first_seen"), *[F.min(number).alias(name) for name, number in numbers.items()]
        )
        window, numbers, seen = F.col("window"), {n: F.col(n) for n in CARRIED_NARROW}, "first_seen"
        by = [window, *IDENTITY]
    else:
        timed = timed.withColumn("window", window)
        by = [F.xxhash64("window", *IDENTITY).alias("hash"), "window", *IDENTITY]
    return (
        timed.groupBy(*by)
        .agg(
            *[lookup.unpacked(F.min(number), types[name]).alias(name) for name, number in numbers.items()],
            *[lookup.earliest_known(name, seen).alias(name) for name in CARRIED_WIDE],
        )
        .withColumns({"event_time": F.col("window.start"), **measures()})
        .select(*COLLAPSED_COLUMNS)
    )
