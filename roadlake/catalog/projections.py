"""Queries for projections and filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import sql
from roadlake.catalog.registry import query
from roadlake.functions import flow, geo, incidents, lookup
from roadlake.operators import areas
from roadlake.operators import flow as flow_ops
from roadlake.operators import incidents as incident_ops
from roadlake.sources import adapters, responses

FLOW_ID = ["location_name", "ingested_at"]
INCIDENT_ID = ["bbox_name", "category", "from_location", "to_location"]

ENRICHED_COLUMNS = [
    "location_name", "ingested_at", "event_time", "lat", "lon", "city", "frc", "frc_label", "current_speed_kmh",
    "free_flow_speed_kmh", "current_travel_time", "free_flow_travel_time", "confidence", "road_closed",
    "congestion_ratio", "speed_drop_pct", "travel_time_delay_seconds", "travel_time_delay_minutes",
    "congestion_severity_score", "congestion_level", "confidence_band",
]
INCIDENT_COLUMNS = [
    *INCIDENT_ID, "event_time", "city", "icon_category_id", "magnitude", "magnitude_label", "delay_seconds",
    "delay_minutes", "length_meters", "length_km", "road_numbers", "start_time_parsed", "end_time_parsed",
    "incident_duration_minutes", "is_road_closure", "has_known_location", "is_active", "lat", "lon",
]


def flow_projection(name: str, columns: Callable[[], dict[str, Column]], output: list[str]) -> None:
    """A projection of single readings, checked against the same column of the SQL enrichment."""

    @query(name, sql.with_(sql.ENRICHED) + f"SELECT {sql.rounded(FLOW_ID + output)} FROM enriched")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = columns()
        return adapters.flow_readings(spark, sf_dir).select(
            *FLOW_ID, *[(made[c].alias(c) if c in made else F.col(c)) for c in output]
        )


flow_projection(
    "prj_geo_fallback", lambda: {"lat": flow.segment_or_query("lat"), "lon": flow.segment_or_query("lon")},
    ["lat", "lon"],
)
flow_projection("prj_event_time", lambda: {"event_time": flow.event_time()}, ["event_time"])
flow_projection("prj_city", lambda: {"city": lookup.city_of(F.col("location_name"))}, ["city"])
flow_projection("prj_road_class", lambda: {"frc_label": lookup.road_class_label(F.col("frc"))}, ["frc", "frc_label"])
flow_projection("prj_ratio_fill", lambda: {"congestion_ratio": flow.filled_ratio()}, ["congestion_ratio"])
flow_projection("prj_speed_drop", lambda: {"speed_drop_pct": flow.speed_drop_pct()}, ["speed_drop_pct"])
flow_projection(
    "prj_delay_seconds", lambda: {"travel_time_delay_seconds": flow.delay_seconds()}, ["travel_time_delay_seconds"]
)
flow_projection(
    "prj_delay_minutes", lambda: {"travel_time_delay_minutes": flow.delay_minutes()}, ["travel_time_delay_minutes"]
)
flow_projection(
    "prj_severity", lambda: {"congestion_severity_score": flow.severity_score()}, ["congestion_severity_score"]
)
flow_projection(
    "prj_congestion_level", lambda: {"congestion_level": flow.congestion_level()}, ["road_closed", "congestion_level"]
)
flow_projection(
    "prj_confidence_band", lambda: {"confidence_band": flow.confidence_band()}, ["confidence", "confidence_band"]
)


@query("flow_enriched", sql.with_(sql.ENRICHED) + f"SELECT {sql.rounded(ENRICHED_COLUMNS)} FROM enriched")
def flow_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_ops.enrich_readings(adapters.flow_readings(spark, sf_dir)).select(*ENRICHED_COLUMNS)


@query(
    "prj_ratio_compute",
    sql.with_(sql.READINGS)
    + "SELECT location_name, ingested_at, current_speed_kmh, free_flow_speed_kmh, "
    "round(congestion_ratio::DOUBLE, 6) AS congestion_ratio FROM readings",
)
def prj_ratio_compute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.flow_readings(spark, sf_dir).select(
        *FLOW_ID, "current_speed_kmh", "free_flow_speed_kmh",
        flow.speed_ratio(F.col("current_speed_kmh"), F.col("free_flow_speed_kmh")).alias("congestion_ratio"),
    )


def incident_projection(name: str, output: list[str]) -> None:
    """Columns of enriched reports; what is not selected is pruned from the plan."""

    @query(name, sql.with_(sql.INCIDENTS) + f"SELECT {', '.join(INCIDENT_ID + output)} FROM incidents")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return incident_ops.enrich_incidents(adapters.incident_polls(spark, sf_dir)).select(*INCIDENT_ID, *output)


incident_projection("prj_incident_duration", ["start_time_parsed", "end_time_parsed", "incident_duration_minutes"])
incident_projection("prj_incident_delay", ["delay_seconds", "delay_minutes"])
incident_projection("prj_length_km", ["length_meters", "length_km"])
incident_projection("prj_magnitude_label", ["magnitude", "magnitude_label"])
incident_projection("prj_is_closure", ["is_road_closure"])
incident_projection("prj_has_location", ["lat", "lon", "has_known_location"])
incident_projection("prj_is_active", ["event_time", "is_active"])
incident_projection("incident_enriched", INCIDENT_COLUMNS[len(INCIDENT_ID):])


@query(
    "prj_parse_iso",
    sql.with_(sql.POLLS) + f"SELECT start_time, try_strptime(start_time, {sql.ISO}) AS start_time_parsed, "
    f"end_time, try_strptime(end_time, {sql.ISO}) AS end_time_parsed FROM polls",
)
def prj_parse_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.incident_polls(spark, sf_dir).select(
        "start_time", incidents.parsed_time("start_time").alias("start_time_parsed"),
        "end_time", incidents.parsed_time("end_time").alias("end_time_parsed"),
    )


@query(
    "prj_category_name",
    sql.with_(sql.POLLS, sql.CATEGORY_NAMES)
    + "SELECT bbox_name, ingested_at, icon_category_id, coalesce(cat_name, 'Unknown') AS category_name "
    "FROM polls LEFT JOIN category_names ON icon_category_id = cat_id",
)
def prj_category_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.incident_polls(spark, sf_dir).select(
        "bbox_name", "ingested_at", "icon_category_id",
        lookup.category_name(F.col("icon_category_id")).alias("category_name"),
    )


@query(
    "prj_record_key",
    sql.with_(sql.AREAS)
    + "SELECT area || '_' || (row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderkey) - 1) "
    "AS record_key, area AS bbox_name, "
    "CASE WHEN o_orderkey % 9 <> 0 THEN 'P' || (o_custkey % 50) END AS from_location "
    "FROM orders JOIN areas ON (o_orderkey // 10) % 4 = pos",
)
def prj_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = responses.incident_records(adapters.raw_incident_json(spark, sf_dir), with_key=True)
    return records.select("record_key", "bbox_name", "from_location")


@query(
    "prj_join_list",
    "SELECT CASE WHEN o_orderkey % 4 < 2 THEN NULL WHEN o_orderkey % 4 = 2 THEN 'R' || (o_orderkey % 20) "
    "ELSE 'R' || (o_orderkey % 20) || ', M1' END AS road_numbers, count(*) AS incidents FROM orders GROUP BY 1",
)
def prj_join_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = responses.incident_records(adapters.raw_incident_json(spark, sf_dir))
    return records.groupBy("road_numbers").agg(F.count(F.lit(1)).alias("incidents"))


@query(
    "prj_point_geom",
    sql.with_(sql.POLLS)
    + "SELECT bbox_name, ingested_at, lat AS point_lat, lon AS point_lon, "
    "CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 4326 END AS srid, "
    "CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 'POINT(' || lon || ' ' || lat || ')' END AS wkt FROM polls",
)
def prj_point_geom(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = adapters.incident_polls(spark, sf_dir).withColumn("geom", geo.point(F.col("lat"), F.col("lon")))
    return at.select(
        "bbox_name", "ingested_at", F.col("geom.lat").alias("point_lat"), F.col("geom.lon").alias("point_lon"),
        F.col("geom.srid").alias("srid"), F.col("geom.wkt").alias("wkt"),
    )


@query(
    "flt_bbox_points",
    sql.with_(sql.READINGS, sql.AREAS)
    + "SELECT location_name, ingested_at, query_lat, query_lon, area FROM readings JOIN areas "
    "ON query_lat BETWEEN lat0 AND lat1 AND query_lon BETWEEN lon0 AND lon1",
)
def flt_bbox_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = adapters.flow_readings(spark, sf_dir).select(*FLOW_ID, "query_lat", "query_lon")
    return areas.points_by_area(readings, lat="query_lat", lon="query_lon")
