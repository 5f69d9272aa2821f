"""The generic benchmark tables seen through the two record contracts.

``events`` become speed readings and ``lineitem`` with ``orders`` become incident
polls, row for row, so that every operator can be run on them at any scale and be
checked with plain SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions import codes
from roadlake.functions.flow import speed_ratio
from roadlake.functions.lookup import nth

FLOW_EPOCH_MS = 1704067200000  # 2024-01-01T00:00Z
POLL_EPOCH_S = 1704067200
TIME_SQUEEZE = 24  # thirty days of events become thirty hours of readings
POINTS = sorted((name, lat, lon) for name, _city, lat, lon in codes.MONITORED_POINTS)
PLACES = POINTS + [("unlisted_point", 30.0, 31.0)]
POLLED = list(codes.CATEGORIES.items()) + [(13, "Car stopped")]
SCHEMA_ID = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    place = F.col("user_id") % len(PLACES)
    step1 = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000").alias("ms"),
        place.cast("int").alias("li"),
    )
    step2 = step1.select(
        "*",
        F.when(F.col("event_id") % 13 == 0, F.lit(0)).otherwise(40 + 2 * F.col("li")).alias("ff"),
    )
    return step2.select(
        "*",
        F.when(F.col("ff") == 0, F.lit(0))
        .otherwise(F.least(F.col("ff"), F.floor("value").cast("int")))
        .alias("cs"),
    )


def _reading_columns() -> list[Column]:
    lat = nth([p[1] for p in PLACES], F.col("li"))
    lon = nth([p[2] for p in PLACES], F.col("li"))
    on_segment = F.col("event_id") % 5 != 0
    return [
        (F.lit(FLOW_EPOCH_MS) + F.expr(f"(ms - {FLOW_EPOCH_MS}) div {TIME_SQUEEZE}")).alias("ingested_at"),
        nth([p[0] for p in PLACES], F.col("li")).alias("location_name"),
        lat.alias("query_lat"),
        lon.alias("query_lon"),
        F.when(on_segment, lat + 0.001).alias("segment_lat"),
        F.when(on_segment, lon + 0.001).alias("segment_lon"),
        F.concat(F.lit("FRC"), (F.col("user_id") % 8).cast("string")).alias("frc"),
        F.col("cs").alias("current_speed_kmh"),
        F.col("ff").alias("free_flow_speed_kmh"),
        # Dividing as doubles: exact at this size, and there is no integer division by a column.
        F.coalesce(F.floor(F.try_divide((60 + F.col("li")) * F.col("ff").cast("double"), F.col("cs").cast("double"))), F.lit(600))
        .cast("int")
        .alias("current_travel_time"),
        (60 + F.col("li")).alias("free_flow_travel_time"),
        ((F.col("event_id") % 11) / 10.0).cast("float").alias("confidence"),
        ((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0)).alias("road_closed"),
        speed_ratio(F.col("cs"), F.col("ff")).alias("congestion_ratio"),
    ]


def flow_readings(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Speed readings; ``extra`` keeps columns of the event (event_id, ts)."""
    return _base_readings(spark, sf_dir).select(*extra, *_reading_columns())


def _iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def incident_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident polls: one order line is one poll of the order's incident."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    polls = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    polls = polls.withColumn("t", F.lit(POLL_EPOCH_S) + (k % 1100) * 86400 + (k % 96) * 900)
    t = F.col("t")
    area = cust % len(codes.AREAS)
    centre_lat = nth([(a[2] + a[4]) / 2 for a in codes.AREAS], area)
    centre_lon = nth([(a[3] + a[5]) / 2 for a in codes.AREAS], area)
    placed = k % 6 != 0
    return polls.select(
        ((t + (F.col("l_linenumber") - 1) * 360) * 1000 + 123).alias("ingested_at"),
        nth([a[0] for a in codes.AREAS], area).alias("bbox_name"),
        nth([name for _, name in POLLED], k % len(POLLED)).alias("category"),
        nth([i for i, _ in POLLED], k % len(POLLED)).alias("icon_category_id"),
        (F.col("l_quantity").cast("int") % 6).alias("magnitude"),
        F.when(k % 9 != 0, F.concat(F.lit("P"), (cust % 50).cast("string"))).alias("from_location"),
        F.when(k % 10 != 0, F.concat(F.lit("Q"), (cust % 40).cast("string"))).alias("to_location"),
        (F.col("l_quantity").cast("int") * 30).alias("delay_seconds"),
        F.floor("l_extendedprice").cast("int").alias("length_meters"),
        F.when(k % 4 != 0, F.concat(F.lit("R"), (k % 20).cast("string"))).alias("road_numbers"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.lit("n/a")).otherwise(_iso(t - 1800)).alias("start_time"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 13 == 0, _iso(t + 360)).otherwise(_iso(t + 5400)).alias("end_time"),
        F.lit("PRESENT").alias("time_validity"),
        F.lit("CERTAIN").alias("probability_of_occurrence"),
        F.col("l_linenumber").alias("number_of_reports"),
        F.lit(None).cast("string").alias("last_report_time"),
        F.when(placed, centre_lat + (k % 10) * 0.001).alias("lat"),
        F.when(placed, centre_lon + (k % 10) * 0.001).alias("lon"),
    )


def raw_flow_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flow responses: fields holding a default are left out, 0..4 coordinates."""
    base = _base_readings(spark, sf_dir).select("event_id", *_reading_columns())
    points = F.expr(
        "transform(sequence(1, cast(event_id % 5 as int)), "
        "i -> named_struct('latitude', query_lat + 0.001 * i, 'longitude', query_lon + 0.001 * i))"
    )
    no_points = F.expr("cast(array() as array<struct<latitude: double, longitude: double>>)")
    segment = F.struct(
        F.when(F.col("event_id") % 17 != 0, F.col("frc")).alias("frc"),
        F.when(F.col("current_speed_kmh") > 0, F.col("current_speed_kmh")).alias("currentSpeed"),
        F.when(F.col("free_flow_speed_kmh") > 0, F.col("free_flow_speed_kmh")).alias("freeFlowSpeed"),
        F.col("current_travel_time").alias("currentTravelTime"),
        F.col("free_flow_travel_time").alias("freeFlowTravelTime"),
        F.when(F.col("event_id") % 11 != 0, (F.col("event_id") % 11) / 10.0).alias("confidence"),
        F.when(F.col("road_closed"), F.col("road_closed")).alias("roadClosure"),
        F.struct(F.when(F.col("event_id") % 5 == 0, no_points).otherwise(points).alias("coordinate")).alias(
            "coordinates"
        ),
    )
    return base.select(
        "ingested_at",
        "location_name",
        "query_lat",
        "query_lon",
        F.to_json(F.struct(segment.alias("flowSegmentData"))).alias("body"),
    )


def broken_flow_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flow responses of which some are cut short, have a fraction or text for a whole
    number, or hold no segment; ``kind`` says which (NULL: sound)."""
    part = F.expr("(ingested_at div 1000) % 40")
    with_speed = F.col("body").contains('"currentSpeed"')
    kind = F.when(part == 0, "cut").when((part == 1) & with_speed, "fraction").when((part == 2) & with_speed, "text").when(part == 3, "empty")
    body = (
        F.when(F.col("kind") == "cut", F.expr("substring(body, 1, length(body) - 3)"))
        .when(F.col("kind") == "fraction", F.regexp_replace("body", r'"currentSpeed":(\d+)', r'"currentSpeed":$1.5'))
        .when(F.col("kind") == "text", F.regexp_replace("body", r'"currentSpeed":(\d+)', r'"currentSpeed":"x$1"'))
        .when(F.col("kind") == "empty", F.lit("{}"))
        .otherwise(F.col("body"))
    )
    return raw_flow_json(spark, sf_dir).withColumn("kind", kind).withColumn("body", body)


def raw_incident_json(spark: SparkSession, sf_dir: str, broken: Column | None = None) -> DataFrame:
    """Raw incident responses of up to 10 incidents (ten neighbouring order keys). In those that
    ``broken`` says the length is text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    lon, lat = 30 + (k % 100) / 100, 31 + (k % 50) / 100
    vertices = (k % 4).cast("int")
    line = F.concat(
        F.lit('{"type":"LineString","coordinates":['),
        F.when(vertices == 0, F.lit("")).otherwise(
            F.array_join(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(vertices, F.lit(1))),
                    lambda i: F.concat(
                        F.lit("["), (lon + i).cast("string"), F.lit(","), (lat + i).cast("string"), F.lit("]")
                    ),
                ),
                ",",
            )
        ),
        F.lit("]}"),
    )
    dot = F.concat(
        F.lit('{"type":"Point","coordinates":['), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]}")
    )
    properties = F.to_json(
        F.struct(
            F.when(k % 15 != 0, (k % 15).cast("int")).alias("iconCategory"),
            F.when(k % 5 != 0, (k % 5).cast("int")).alias("magnitudeOfDelay"),
            F.when(k % 9 != 0, F.concat(F.lit("P"), (F.col("o_custkey") % 50).cast("string"))).alias("from"),
            F.when(k % 8 != 0, (F.col("o_totalprice") / 100).cast("int")).alias("delay"),
            F.floor("o_totalprice").cast("int").alias("length"),
            F.when(k % 4 == 0, F.lit(None).cast("array<string>"))
            .when(k % 4 == 1, F.array().cast("array<string>"))
            .when(k % 4 == 2, F.array(F.concat(F.lit("R"), (k % 20).cast("string"))))
            .otherwise(F.array(F.concat(F.lit("R"), (k % 20).cast("string")), F.lit("M1")))
            .alias("roadNumbers"),
            F.when(k % 7 != 0, _iso(F.lit(POLL_EPOCH_S) + (k % 1100) * 86400)).alias("startTime"),
            F.when(k % 2 == 0, F.lit("PRESENT")).otherwise(F.lit("FUTURE")).alias("timeValidity"),
            F.when(k % 3 != 0, (k % 3).cast("int")).alias("numberOfReports"),
        )
    )
    incident = F.concat(
        F.lit("{"),
        F.when(k % 3 == 0, F.concat(F.lit('"geometry":'), line, F.lit(",")))
        .when(k % 3 == 1, F.concat(F.lit('"geometry":'), dot, F.lit(",")))
        .otherwise(F.lit("")),
        F.lit('"properties":'),
        properties,
        F.lit("}"),
    )
    if broken is not None:
        incident = F.when(broken, F.regexp_replace(incident, r'"length":(\d+)', r'"length":"x$1"')).otherwise(incident)
    grouped = orders.select(F.expr("o_orderkey div 10").alias("doc"), k.alias("k"), incident.alias("incident"))
    docs = grouped.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("k", "incident"))).alias("members"))
    return docs.select(
        ((F.col("doc") + POLL_EPOCH_S) * 1000).alias("ingested_at"),
        nth([a[0] for a in codes.AREAS], F.col("doc") % len(codes.AREAS)).alias("bbox_name"),
        F.concat(
            F.lit('{"incidents":['), F.array_join(F.col("members.incident"), ","), F.lit("]}")
        ).alias("body"),
    )


def record_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as broker messages; some carry a foreign magic byte."""
    readings = flow_readings(spark, sf_dir, "event_id", "ts")
    fields = [c for c in readings.columns if c not in ("event_id", "ts")]
    magic = F.when(F.col("event_id") % 97 == 0, F.lit("01")).otherwise(F.lit("00"))
    schema_id = F.lpad(F.hex(F.lit(SCHEMA_ID) + F.col("event_id") % 3), 8, "0")
    return readings.select(
        F.col("location_name").alias("key"),
        F.concat(F.unhex(F.concat(magic, schema_id)), F.encode(record_json(*fields), "UTF-8")).alias("value"),
        F.col("ts").alias("timestamp"),
    )


def checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as JSON text; in every fifty one is cut short, one lacks a required
    field and one has text in a number field."""
    readings = flow_readings(spark, sf_dir, "event_id", "ts")
    fields = [c for c in readings.columns if c not in ("event_id", "ts")]
    text = record_json(*fields)
    part = F.col("event_id") % 50
    no_frc = record_json(*[c for c in fields if c != "frc"])
    broken = (
        F.when(part == 0, F.expr("substring(body, 1, length(body) - 5)"))
        .when(part == 1, F.col("no_frc"))
        .when(part == 2, F.regexp_replace("body", r'"free_flow_travel_time":(\d+)', r'"free_flow_travel_time":"x$1"'))
        .otherwise(F.col("body"))
    )
    return readings.withColumns({"body": text, "no_frc": no_frc}).select(
        "event_id", F.col("location_name").alias("key"), broken.alias("body"), F.col("ts").alias("timestamp")
    )
