"""Edge cases of single-row measures, as literals."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadlake.functions import calendar, codes, flow, geo, incidents, lookup
from roadlake.operators import areas
from roadlake.operators import flow as flow_ops
from roadlake.operators import incidents as incident_ops
from roadlake.sources import contracts, responses


def reading(**changes):
    row = dict(
        ingested_at=1704067207999, location_name="tahrir_square", query_lat=30.0, query_lon=31.0, segment_lat=30.1,
        segment_lon=31.1, frc="FRC2", current_speed_kmh=30, free_flow_speed_kmh=60, current_travel_time=120,
        free_flow_travel_time=60, confidence=0.9, road_closed=False, congestion_ratio=0.5,
    )
    row.update(changes)
    return row


def enrich(spark, *rows):
    frame = spark.createDataFrame([tuple(r[n] for n in contracts.FLOW_SCHEMA.names) for r in rows], contracts.FLOW_SCHEMA)
    return flow_ops.enrich_readings(frame).collect()


@pytest.mark.parametrize(
    "ratio, closed, level",
    [
        (0.95, False, "light"),  # stored as float, 0.95 is just below the band
        (0.951, False, "free_flow"),
        (0.75, False, "light"),
        (0.7499, False, "moderate"),
        (0.5, False, "moderate"),
        (0.4999, False, "heavy"),
        (None, False, "free_flow"),
        (1.0, True, "road_closed"),
        (0.0, True, "road_closed"),
    ],
)
def test_congestion_level(spark, ratio, closed, level):
    (row,) = enrich(spark, reading(congestion_ratio=ratio, road_closed=closed))
    assert row.congestion_level == level


@pytest.mark.parametrize(
    "confidence, band", [(0.8, "high"), (0.79, "medium"), (0.5, "medium"), (0.49, "low"), (0.0, "low")]
)
def test_confidence_band(spark, confidence, band):
    (row,) = enrich(spark, reading(confidence=confidence))
    assert row.confidence_band == band


def test_event_time_drops_the_milliseconds(spark):
    (row,) = enrich(spark, reading())
    assert row.event_time == datetime(2024, 1, 1, 0, 0, 7)


def test_no_free_flow_and_no_segment(spark):
    (row,) = enrich(spark, reading(free_flow_speed_kmh=0, segment_lat=None, segment_lon=None, congestion_ratio=None))
    assert row.speed_drop_pct is None
    assert (row.lat, row.lon) == (30.0, 31.0)
    assert row.congestion_ratio == 1.0 and row.congestion_severity_score == 0.0


def test_faster_than_free_flow(spark):
    (row,) = enrich(spark, reading(current_speed_kmh=90, congestion_ratio=1.5, current_travel_time=40))
    assert row.speed_drop_pct == -50.0
    assert row.congestion_severity_score == -50.0
    assert row.travel_time_delay_seconds == -20 and row.travel_time_delay_minutes == -0.33


def test_unknown_place_and_class(spark):
    (row,) = enrich(spark, reading(location_name="nowhere", frc="FRC7"))
    assert (row.city, row.frc_label) == ("unknown", "Unknown")


def test_every_place_has_a_city(spark):
    frame = spark.createDataFrame([(p,) for p in codes.CITY_OF_PLACE] + [(None,)], "place string")
    found = dict(frame.select("place", lookup.city_of(F.col("place"))).collect())
    assert found.pop(None) == "unknown"
    assert found == codes.CITY_OF_PLACE
    assert list(found.values()).count("alexandria") == 7


def test_speed_ratio_is_half_even(spark):
    frame = spark.createDataFrame([(1, 16), (3, 16), (0, 50), (5, 0)], "cs int, ff int")
    found = [r[0] for r in frame.select(flow.speed_ratio(F.col("cs"), F.col("ff"))).collect()]
    assert [None if v is None else round(v, 6) for v in found] == [0.062, 0.188, 0.0, None]


def poll(**changes):
    row = dict(
        ingested_at=1704067200000, bbox_name="cairo_east", category="Jam", icon_category_id=6, magnitude=2,
        from_location="A", to_location="B", delay_seconds=90, length_meters=1234, road_numbers=None,
        start_time="2024-01-01T00:00:00Z", end_time="2024-01-01T01:00:00Z", time_validity=None,
        probability_of_occurrence=None, number_of_reports=None, last_report_time=None, lat=30.0, lon=31.0,
    )
    row.update(changes)
    return row


def polls(spark, *rows):
    return spark.createDataFrame(
        [tuple(r[n] for n in contracts.INCIDENT_SCHEMA.names) for r in rows], contracts.INCIDENT_SCHEMA
    )


def enriched_poll(spark, **changes):
    return incident_ops.enrich_incidents(polls(spark, poll(**changes))).first()


@pytest.mark.parametrize(
    "start, end, active, minutes",
    [
        ("2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z", True, 60.0),  # exactly at the start
        ("2023-12-31T23:00:00Z", "2024-01-01T00:00:00Z", True, 60.0),  # exactly at the end
        ("2023-12-31T22:00:00Z", "2023-12-31T23:59:59Z", False, 119.98),
        ("2024-01-01T00:00:01Z", "2024-01-01T01:00:00Z", False, 59.98),
        ("2024-01-01T01:00:00Z", "2024-01-01T00:00:00Z", False, -60.0),
        (None, "2023-01-01T00:00:00Z", True, None),
        ("n/a", "2023-01-01T00:00:00Z", True, None),
        ("2023-01-01T00:00:00Z", None, True, None),
    ],
)
def test_activity_and_duration(spark, start, end, active, minutes):
    row = enriched_poll(spark, start_time=start, end_time=end)
    assert (row.is_active, row.incident_duration_minutes) == (active, minutes)


@pytest.mark.parametrize("magnitude, label", [(0, "Unknown"), (1, "Minor"), (4, "Undefined"), (5, "Unknown"), (None, "Unknown")])
def test_magnitude(spark, magnitude, label):
    assert enriched_poll(spark, magnitude=magnitude).magnitude_label == label


def test_closure_ignores_case_and_units_round(spark):
    row = enriched_poll(spark, category="ROAD closed", delay_seconds=100, length_meters=1234)
    assert row.is_road_closure and row.delay_minutes == 1.67 and row.length_km == 1.234
    assert not {"ingested_at", "start_time", "end_time"} & set(row.asDict())


def test_location_flag(spark):
    assert not enriched_poll(spark, lat=None).has_known_location
    assert enriched_poll(spark).has_known_location


# --- raw responses --------------------------------------------------------------


def flow_response(spark, body):
    frame = spark.createDataFrame(
        [(1, "x", 30.0, 31.0, body)], "ingested_at long, location_name string, query_lat double, query_lon double, body string"
    )
    return responses.flow_records(frame).first()


def test_flow_response_defaults(spark):
    row = flow_response(spark, '{"flowSegmentData":{}}')
    assert (row.frc, row.current_speed_kmh, row.free_flow_speed_kmh, row.confidence) == ("", 0, 0, 0.0)
    assert row.road_closed is False and row.congestion_ratio is None and row.segment_lat is None
    # An empty body holds no reading, and zeros for one without its part would be a false one.
    assert flow_response(spark, "{}") is None and flow_response(spark, '{"other":1}') is None


@pytest.mark.parametrize("count, middle", [(0, None), (1, 0), (2, 1), (3, 1), (4, 2)])
def test_segment_middle(spark, count, middle):
    points = ",".join(f'{{"latitude":{i}.5,"longitude":{i}.25}}' for i in range(count))
    row = flow_response(spark, f'{{"flowSegmentData":{{"coordinates":{{"coordinate":[{points}]}}}}}}')
    expected = (None, None) if middle is None else (middle + 0.5, middle + 0.25)
    assert (row.segment_lat, row.segment_lon) == expected


def incident_response(spark, *incidents_json):
    body = '{"incidents":[' + ",".join(incidents_json) + "]}"
    frame = spark.createDataFrame([(1, "cairo_east", body)], "ingested_at long, bbox_name string, body string")
    return responses.incident_records(frame, with_key=True).collect()


@pytest.mark.parametrize(
    "geometry, position",
    [
        ('{"type":"LineString","coordinates":[[31.0,30.0],[31.5,30.5]]}', (30.5, 31.5)),
        ('{"type":"LineString","coordinates":[[31.0,30.0]]}', (30.0, 31.0)),
        ('{"type":"LineString","coordinates":[]}', (None, None)),
        ('{"type":"Point","coordinates":[31.0,30.0]}', (30.0, 31.0)),
        ('{"type":"Point","coordinates":[31.0]}', (None, None)),
        ('{"type":"Polygon","coordinates":[[[31.0,30.0]]]}', (None, None)),
        ("null", (None, None)),
    ],
)
def test_geometry(spark, geometry, position):
    (row,) = incident_response(spark, f'{{"geometry":{geometry},"properties":{{}}}}')
    assert (row.lat, row.lon) == position


def test_incident_defaults_and_keys(spark):
    first, second = incident_response(
        spark,
        '{"properties":{"iconCategory":12,"delay":null,"roadNumbers":["A1","B2"]}}',
        '{"properties":{"iconCategory":8,"roadNumbers":[]}}',
    )
    assert (first.record_key, second.record_key) == ("cairo_east_0", "cairo_east_1")
    assert (first.category, first.delay_seconds, first.road_numbers) == ("Unknown", 0, "A1, B2")
    assert (second.category, second.length_meters, second.road_numbers) == ("Road closed", 0, None)


def test_empty_and_broken_responses_give_nothing(spark):
    frame = spark.createDataFrame(
        [(1, "a", '{"incidents":[]}'), (1, "a", "{}"), (1, "a", "not json"), (1, "a", None)],
        "ingested_at long, bbox_name string, body string",
    )
    assert responses.incident_records(frame).count() == 0


SOUND = '{"properties":{"iconCategory":8,"length":5}}'


@pytest.mark.parametrize(
    "bad, record",
    [
        ('{"properties":{"length":"five"}}', '{"properties":{"length":"five"}}'),
        ('{"properties":{"iconCategory":1.5}}', '{"properties":{"iconCategory":1.5}}'),
        ('{"properties":[1]}', '{"properties":[1]}'), ("null", "null"), ("7", "7"), ('"text"', "text"),
    ],
)
def test_one_bad_incident_rejects_only_itself(spark, bad, record):
    body = f'{{"incidents":[{SOUND},{bad},{SOUND}]}}'
    frame = spark.createDataFrame([(1, "a", body)], "ingested_at long, bbox_name string, body string")
    sound = responses.incident_records(frame, with_key=True).collect()
    assert [(r.record_key, r.category, r.length_meters) for r in sound] == [("a_0", "Road closed", 5), ("a_2", "Road closed", 5)]
    (dead,) = responses.incident_dead_letters(frame).collect()
    assert (dead.reason, dead.record, dead.position, dead.bbox_name, dead.ingested_at) == ("malformed incident", record, 1, "a", 1)


@pytest.mark.parametrize(
    "body, reason",
    [("{}", "missing incidents"), ("not json", "malformed response"), ('{"incidents":7}', "malformed response"), (None, "malformed response")],
)
def test_responses_without_a_list_are_dead_letters(spark, body, reason):
    frame = spark.createDataFrame([(1, "a", body)], "ingested_at long, bbox_name string, body string")
    (dead,) = responses.incident_dead_letters(frame).collect()
    assert (dead.reason, dead.record, dead.position) == (reason, body, None) and responses.incident_records(frame).isEmpty()


# --- geography and calendar -----------------------------------------------------


def test_areas_overlap_and_include_their_edges(spark):
    frame = spark.createDataFrame([(1, 30.05, 31.35), (2, 31.2, 30.0), (3, 0.0, 0.0), (4, None, 31.2)], "id int, lat double, lon double")
    found = sorted((r.id, r.area) for r in areas.points_by_area(frame).collect())
    assert found == [
        (1, "cairo_downtown"), (1, "cairo_east"), (1, "cairo_ring_road"), (2, "alexandria"),
    ]


def test_point_needs_both_coordinates(spark):
    frame = spark.createDataFrame([(30.5, 31.25), (None, 31.0), (30.0, None)], "lat double, lon double")
    points = [r[0] for r in frame.select(geo.point(F.col("lat"), F.col("lon"))).collect()]
    assert points[0].wkt == "POINT(31.25 30.5)" and points[0].srid == 4326
    assert points[1:] == [None, None]


def test_calendar_day(spark):
    frame = spark.createDataFrame([("2024-12-27",)], "d string").select(F.col("d").cast("date").alias("d"))
    day = frame.select(*[c.alias(n) for n, c in calendar.day_attributes(F.col("d")).items()]).first()
    assert (day.date_key, day.day_of_week, day.is_weekend, day.day_type) == (20241227, 5, True, "Weekend")
    assert (day.month_name_en, day.day_name_en, day.season) == ("December", "Friday", "Winter")


def test_window_edge(spark):
    rows = [reading(ingested_at=1704067200000 + ms) for ms in (899_999, 900_000)]
    frame = spark.createDataFrame([tuple(r[n] for n in contracts.FLOW_SCHEMA.names) for r in rows], contracts.FLOW_SCHEMA)
    rolled = flow_ops.roll_up_readings(flow_ops.enrich_readings(frame))
    assert sorted(r.window_start.minute for r in rolled.collect()) == [0, 15]
