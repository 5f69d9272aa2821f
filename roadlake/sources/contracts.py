"""Record contracts of the two feeds and shapes of their raw responses."""

from __future__ import annotations

from pyspark.sql import types as T


# Field names, types and order of the two record contracts.
FLOW_FIELDS = [
    ("ingested_at", T.LongType(), True),
    ("location_name", T.StringType(), True),
    ("query_lat", T.DoubleType(), True),
    ("query_lon", T.DoubleType(), True),
    ("segment_lat", T.DoubleType(), False),
    ("segment_lon", T.DoubleType(), False),
    ("frc", T.StringType(), True),
    ("current_speed_kmh", T.IntegerType(), True),
    ("free_flow_speed_kmh", T.IntegerType(), True),
    ("current_travel_time", T.IntegerType(), True),
    ("free_flow_travel_time", T.IntegerType(), True),
    ("confidence", T.FloatType(), True),
    ("road_closed", T.BooleanType(), True),
    ("congestion_ratio", T.FloatType(), False),
]

INCIDENT_FIELDS = [
    ("ingested_at", T.LongType(), True),
    ("bbox_name", T.StringType(), True),
    ("category", T.StringType(), True),
    ("icon_category_id", T.IntegerType(), True),
    ("magnitude", T.IntegerType(), True),
    ("from_location", T.StringType(), False),
    ("to_location", T.StringType(), False),
    ("delay_seconds", T.IntegerType(), True),
    ("length_meters", T.IntegerType(), True),
    ("road_numbers", T.StringType(), False),
    ("start_time", T.StringType(), False),
    ("end_time", T.StringType(), False),
    ("time_validity", T.StringType(), False),
    ("probability_of_occurrence", T.StringType(), False),
    ("number_of_reports", T.IntegerType(), False),
    ("last_report_time", T.StringType(), False),
    ("lat", T.DoubleType(), False),
    ("lon", T.DoubleType(), False),
]

# Fields that fall back to 0 when a record leaves them out.
INCIDENT_ZERO_DEFAULTS = ["delay_seconds", "length_meters"]

# Parsing always yields nullable columns; what is required is checked, not assumed.
FLOW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t, _ in FLOW_FIELDS])
INCIDENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t, _ in INCIDENT_FIELDS])
FLOW_REQUIRED = [n for n, _, required in FLOW_FIELDS if required]
INCIDENT_REQUIRED = [n for n, _, required in INCIDENT_FIELDS if required]

# Raw flow response: one measured road segment.
RAW_FLOW = """
    flowSegmentData STRUCT<
        frc: STRING, currentSpeed: INT, freeFlowSpeed: INT,
        currentTravelTime: INT, freeFlowTravelTime: INT,
        confidence: DOUBLE, roadClosure: BOOLEAN,
        coordinates: STRUCT<coordinate: ARRAY<STRUCT<latitude: DOUBLE, longitude: DOUBLE>>>>
"""

# Raw incident response. Incidents are taken out as text first, so that one that does not fit
# its contract is rejected by itself.
RAW_INCIDENTS = "incidents ARRAY<STRING>"

# One raw incident. ``coordinates`` holds pairs for a line and one pair for a point, so it is
# kept as text here and parsed once the geometry type is known.
RAW_INCIDENT = """
    geometry STRUCT<type: STRING, coordinates: STRING>,
    properties STRUCT<
        iconCategory: INT, magnitudeOfDelay: INT, `from`: STRING, `to`: STRING,
        delay: INT, length: INT, roadNumbers: ARRAY<STRING>,
        startTime: STRING, endTime: STRING, timeValidity: STRING,
        probabilityOfOccurrence: STRING, numberOfReports: INT, lastReportTime: STRING>
"""
