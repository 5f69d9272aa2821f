"""Ready-made reads of the fact tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.operators import areas

LATEST = 100


def _mean(column: str) -> Column:
    return F.avg(column).alias(f"mean_{column}")


def latest_windows(flow_facts: DataFrame, since: int, n: int = LATEST) -> DataFrame:
    """The newest ``n`` flow rows, read from the days that surely hold them (see
    ``lake.certain_since``); each task keeps its own top ``n``, no full sort."""
    return flow_facts.where(F.col("date_key") >= since).orderBy(F.desc("window_start_utc"), F.asc_nulls_first("location_sk")).limit(n)


def location_history(read: Callable[[list[str]], DataFrame], location: DataFrame, location_sk: int) -> DataFrame:
    """Rows of one location version. Its name identifies facts, so ``read`` gets the names to
    leave out files without them, and the filter reaches the scan."""
    names = [r.location_key for r in location.where(F.col("location_sk") == location_sk).select("location_key").collect()]
    # Without such a version no name is asked for, and no row is left.
    return read(names or [""]).where(F.col("location_name").isin(names) & (F.col("location_sk") == location_sk))


def flow_by_date_location(flow_facts: DataFrame) -> DataFrame:
    return flow_facts.groupBy("date_key", "location_sk").agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("sample_count").alias("readings"),
        _mean("avg_speed_kmh"),
        F.min("min_speed_kmh").alias("min_speed_kmh"),
        F.max("max_speed_kmh").alias("max_speed_kmh"),
        _mean("avg_congestion_ratio"),
    )


def flow_by_level(flow_facts: DataFrame) -> DataFrame:
    return flow_facts.groupBy("congestion_level").agg(
        F.count(F.lit(1)).alias("windows"), _mean("avg_speed_kmh"), _mean("avg_travel_time_delay_minutes")
    )


def active_incidents(incident_facts: DataFrame) -> DataFrame:
    """Incidents active when polled, newest window first."""
    return incident_facts.where("is_active_at_ingestion").orderBy(F.desc("window_start_utc"))


def incidents_by_location(incident_facts: DataFrame) -> DataFrame:
    return incident_facts.groupBy("location_sk").agg(
        F.count(F.lit(1)).alias("incidents"), F.sum("delay_seconds").alias("delay_seconds")
    )


def incidents_by_category(incident_facts: DataFrame, category: DataFrame) -> DataFrame:
    """Counts per category with its group and severity; categories without a member count as Unknown.

    Facts are reduced to one row per key before the join.
    """
    per_key = incident_facts.groupBy("category_sk").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.sum("delay_seconds").alias("delay_seconds"),
        F.count_if("is_road_closure").alias("closures"),
    )
    named = category.select("category_sk", "category_label_en", "category_group", "severity_level", "severity_rank")
    return (
        per_key.join(named, "category_sk", "left")
        .withColumns(
            {
                "category_label_en": F.coalesce("category_label_en", F.lit("Unknown")),
                "category_group": F.coalesce("category_group", F.lit("Other")),
                "severity_level": F.coalesce("severity_level", F.lit("low")),
                "severity_rank": F.coalesce("severity_rank", F.lit(1)),
            }
        )
        .groupBy("category_label_en", "category_group", "severity_level", "severity_rank")
        .agg(
            F.sum("incidents").alias("incidents"),
            F.sum("delay_seconds").alias("delay_seconds"),
            F.sum("closures").alias("closures"),
        )
    )


def incidents_by_date_location(incident_facts: DataFrame) -> DataFrame:
    return incident_facts.groupBy("date_key", "location_sk").agg(
        F.count(F.lit(1)).alias("incidents"), F.count_if("is_road_closure").alias("closures")
    )


def incidents_by_magnitude(incident_facts: DataFrame) -> DataFrame:
    return incident_facts.groupBy("magnitude", "magnitude_label").agg(
        F.count(F.lit(1)).alias("incidents"), _mean("delay_minutes"), _mean("length_km")
    )


def incidents_in_area(incident_facts: DataFrame) -> DataFrame:
    """Incident rows per area; a row counts in each area it lies in."""
    return areas.points_by_area(incident_facts).groupBy("area").agg(
        F.count(F.lit(1)).alias("incidents"), F.count_if("is_road_closure").alias("closures")
    )
