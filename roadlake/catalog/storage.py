"""Queries for sources, generators and sinks: what is written is read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import rollups, sql
from roadlake.catalog.registry import query
from roadlake.functions import calendar, codes
from roadlake.functions import flow as flow_columns
from roadlake.operators import contract, flow, incidents, keys, merge, quality
from roadlake.plans import marts
from roadlake.session import fresh_folder
from roadlake.sinks import compaction, writers
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import adapters, contracts, dimensions, responses, wire

FLOW_COLUMNS = contracts.FLOW_SCHEMA.names
INCIDENT_COLUMNS = contracts.INCIDENT_SCHEMA.names


def new_lake(spark: SparkSession, purpose: str) -> Lake:
    """An empty lake."""
    return Lake(spark, fresh_folder(spark, purpose))


# --- sources --------------------------------------------------------------------


@query(
    "src_wire_envelope",
    sql.with_(sql.READINGS)
    + f"SELECT location_name AS key, ts AS timestamp, CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END AS magic, "
    f"{adapters.SCHEMA_ID} + event_id % 3 AS schema_id FROM readings",
)
def src_wire_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.split_envelope(adapters.wire_messages(spark, sf_dir))
    return messages.select("key", "timestamp", "magic", "schema_id")


@query(
    "src_payload_decode",
    sql.with_(sql.READINGS)
    + f"SELECT {sql.rounded(FLOW_COLUMNS)}, ts AS timestamp FROM readings WHERE event_id % 97 <> 0",
)
def src_payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.split_envelope(adapters.wire_messages(spark, sf_dir)).where(F.col("magic") == wire.MAGIC)
    return wire.decode_payload(messages, contracts.FLOW_SCHEMA)


@query(
    "src_flow_json_normalize",
    sql.with_(sql.READINGS)
    + "SELECT "
    + sql.rounded([c for c in FLOW_COLUMNS if c not in ("segment_lat", "segment_lon", "frc")])
    + ", CASE WHEN event_id % 17 = 0 THEN '' ELSE frc END AS frc, "
    "CASE WHEN event_id % 5 > 0 THEN query_lat + 0.001::DOUBLE * ((event_id % 5) // 2 + 1) END AS segment_lat, "
    "CASE WHEN event_id % 5 > 0 THEN query_lon + 0.001::DOUBLE * ((event_id % 5) // 2 + 1) END AS segment_lon "
    "FROM readings",
)
def src_flow_json_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.flow_records(adapters.raw_flow_json(spark, sf_dir))


@query(
    "src_response_dead_letters",
    sql.with_(sql.READINGS)
    + "SELECT location_name, ingested_at, CASE (ingested_at // 1000) % 40 WHEN 0 THEN 'malformed response' "
    "WHEN 3 THEN 'missing flowSegmentData' ELSE CASE WHEN (ingested_at // 1000) % 40 IN (1, 2) AND current_speed_kmh > 0 "
    "THEN 'malformed response' END END AS reason, "
    "CASE WHEN (ingested_at // 1000) % 40 IN (0, 3) OR ((ingested_at // 1000) % 40 IN (1, 2) AND current_speed_kmh > 0) "
    "THEN NULL ELSE current_speed_kmh END AS current_speed_kmh FROM readings",
)
def src_response_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound and broken responses: each is a record or a dead letter, none is read as zeros."""
    bodies = adapters.broken_flow_json(spark, sf_dir)
    records = responses.flow_records(bodies).select("location_name", "ingested_at", F.lit(None).cast("string").alias("reason"), "current_speed_kmh")
    dead = responses.dead_letters(bodies, contracts.RAW_FLOW, responses.FLOW_PART)
    return records.unionByName(dead.select("location_name", "ingested_at", "reason", F.lit(None).cast("int").alias("current_speed_kmh")))


INCIDENT_JSON_SQL = sql.with_(sql.AREAS, sql.CATEGORY_NAMES) + f""",
o AS (SELECT o_orderkey AS k, o_custkey, o_totalprice, CAST(o_orderkey % 4 AS INTEGER) // 2 + 1 AS mid,
        30 + (o_orderkey % 100) / 100.0::DOUBLE AS lon0_, 31 + (o_orderkey % 50) / 100.0::DOUBLE AS lat0_ FROM orders)
SELECT {adapters.POLL_EPOCH_S * 1000} + (k // 10) * 1000 AS ingested_at, area AS bbox_name,
  coalesce(cat_name, 'Unknown') AS category, k % 15 AS icon_category_id, k % 5 AS magnitude,
  CASE WHEN k % 9 <> 0 THEN 'P' || (o_custkey % 50) END AS from_location, CAST(NULL AS VARCHAR) AS to_location,
  CASE WHEN k % 8 <> 0 THEN CAST(floor(o_totalprice / 100) AS INTEGER) ELSE 0 END AS delay_seconds,
  CAST(floor(o_totalprice) AS INTEGER) AS length_meters,
  CASE WHEN k % 4 < 2 THEN NULL WHEN k % 4 = 2 THEN 'R' || (k % 20) ELSE 'R' || (k % 20) || ', M1' END AS road_numbers,
  CASE WHEN k % 7 <> 0 THEN {sql.iso(f"{adapters.POLL_EPOCH_S} + (k % 1100) * 86400")} END AS start_time,
  CAST(NULL AS VARCHAR) AS end_time, CASE WHEN k % 2 = 0 THEN 'PRESENT' ELSE 'FUTURE' END AS time_validity,
  CAST(NULL AS VARCHAR) AS probability_of_occurrence, CASE WHEN k % 3 <> 0 THEN k % 3 END AS number_of_reports,
  CAST(NULL AS VARCHAR) AS last_report_time,
  CASE WHEN k % 3 = 0 AND k % 4 > 0 THEN lat0_ + mid WHEN k % 3 = 1 THEN lat0_ END AS lat,
  CASE WHEN k % 3 = 0 AND k % 4 > 0 THEN lon0_ + mid WHEN k % 3 = 1 THEN lon0_ END AS lon
FROM o JOIN areas ON (k // 10) % 4 = pos LEFT JOIN category_names ON k % 15 = cat_id"""


@query("src_incident_json_explode", INCIDENT_JSON_SQL.replace("\n,\no AS", ",\no AS"))
def src_incident_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.incident_records(adapters.raw_incident_json(spark, sf_dir))


@query(
    "src_incident_dead_letters",
    sql.with_(sql.AREAS) + f"SELECT area AS bbox_name, {adapters.POLL_EPOCH_S * 1000} + (o_orderkey // 10) * 1000 AS ingested_at, "
    "CASE WHEN o_orderkey % 40 = 7 THEN o_orderkey % 10 END AS position, "
    "CASE WHEN o_orderkey % 40 = 7 THEN 'malformed incident' END AS reason, "
    "CASE WHEN o_orderkey % 40 <> 7 THEN CAST(floor(o_totalprice) AS INTEGER) END AS length_meters "
    "FROM orders JOIN areas ON (o_orderkey // 10) % 4 = pos",
)
def src_incident_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with some incidents of a wrong type: those alone are dead letters, in their place."""
    bodies = adapters.raw_incident_json(spark, sf_dir, F.col("o_orderkey") % 40 == 7)
    records = responses.incident_records(bodies).select(
        "bbox_name", "ingested_at", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("reason"), "length_meters"
    )
    dead = responses.incident_dead_letters(bodies).select(
        "bbox_name", "ingested_at", "position", "reason", F.lit(None).cast("int").alias("length_meters")
    )
    return records.unionByName(dead)


@query(
    "src_dim_scan",
    sql.with_(rollups.ROLLED) + "SELECT location_key, version_number, is_current FROM rolled_locations",
)
def src_dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores the rolled location dimension and scans three of its columns."""
    path = new_lake(spark, "dimension").path("dim_location")
    rollups.rolled_locations(spark, sf_dir).write.parquet(path)
    return dimensions.scan_dimension(spark, path, ["location_key", "version_number", "is_current"])


@query(
    "src_partition_scan",
    sql.with_(sql.ENRICHED) + "SELECT location_name, ingested_at, current_speed_kmh FROM enriched "
    "WHERE CAST(event_time AS DATE) = DATE '2024-01-02'",
)
def src_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands all readings, then reads the folders of one day."""
    lake = new_lake(spark, "landing")
    writers.land(adapters.flow_readings(spark, sf_dir), lake, tables.LANDING_FLOW, "b0")
    day = lake.read(tables.LANDING_FLOW)
    for predicate in compaction.day_predicate(date(2024, 1, 3)):
        day = day.where(predicate)
    return day.select("location_name", "ingested_at", "current_speed_kmh")


# --- generators and seeds, with what refers to each member -----------------------


def poll_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date(flow_columns.event_time())
    return adapters.incident_polls(spark, sf_dir).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("polls"))


def calendar_with_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar covering all polls, with the number of polls of each day."""
    days = poll_days(spark, sf_dir)
    dates = dimensions.date_dimension(dimensions.calendar_days_covering(days))
    counted = dates.join(days, dates["full_date"] == days["day"], "left").drop("day")
    return counted.withColumn("polls", F.coalesce("polls", F.lit(0)))


CALENDAR_SQL = sql.INCIDENTS + ",\n" + sql.COVERING_DAYS + ",\n" + sql.date_dimension("covering_days")


@query(
    "gen_dim_date",
    sql.with_(CALENDAR_SQL)
    + "SELECT d.*, coalesce(polls, 0) AS polls FROM dim_date d LEFT JOIN poll_days USING (full_date)",
)
def gen_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_with_polls(spark, sf_dir)


@query(
    "snk_keyed_update",
    sql.with_(CALENDAR_SQL, sql.HOLIDAYS)
    + "SELECT d.* REPLACE (holiday IS NOT NULL AS is_public_holiday, holiday AS holiday_name, "
    "CASE WHEN holiday IS NOT NULL THEN 'Holiday' ELSE day_type END AS day_type), coalesce(polls, 0) AS polls "
    "FROM dim_date d LEFT JOIN poll_days USING (full_date) "
    "LEFT JOIN holidays ON full_date = CAST(holiday_date AS DATE)",
)
def snk_keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.update_by_key(
        calendar_with_polls(spark, sf_dir), dimensions.holiday_updates(spark), "full_date",
        ["is_public_holiday", "holiday_name", "day_type"],
    )


@query(
    "gen_dim_time",
    sql.with_(sql.ENRICHED, sql.DIM_TIME)
    + "SELECT t.*, coalesce(readings, 0) AS readings FROM dim_time t LEFT JOIN (SELECT "
    "hour(event_time) * 4 + minute(event_time) // 15 AS time_key, count(*) AS readings FROM enriched GROUP BY ALL) "
    "USING (time_key)",
)
def gen_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots, with the number of readings in each."""
    slot = calendar.slot_of(flow_columns.event_time())
    used = adapters.flow_readings(spark, sf_dir).groupBy(slot.alias("time_key")).agg(
        F.count(F.lit(1)).alias("readings")
    )
    joined = dimensions.time_dimension(spark).join(used, "time_key", "left")
    return joined.withColumn("readings", F.coalesce("readings", F.lit(0)))


@query(
    "seed_dim_category",
    sql.with_(sql.POLLS, sql.DIM_CATEGORY)
    + "SELECT c.*, coalesce(polls, 0) AS polls FROM dim_incident_category c LEFT JOIN "
    "(SELECT category, count(*) AS polls FROM polls GROUP BY ALL) ON category = category_raw",
)
def seed_dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded categories, with the number of polls of each."""
    used = adapters.incident_polls(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("polls"))
    seed = dimensions.category_dimension(spark)
    joined = seed.join(used, seed["category_raw"] == used["category"], "left").drop("category")
    return joined.withColumn("polls", F.coalesce("polls", F.lit(0)))


@query(
    "seed_dim_location",
    sql.with_(sql.READINGS, sql.DIM_LOCATION)
    + "SELECT d.*, coalesce(readings, 0) AS readings, 'POINT(' || lon || ' ' || lat || ')' AS wkt "
    "FROM dim_location d LEFT JOIN (SELECT location_name AS location_key, count(*) AS readings FROM readings "
    "GROUP BY ALL) USING (location_key)",
)
def seed_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded locations, with the number of readings of each."""
    used = adapters.flow_readings(spark, sf_dir).groupBy(F.col("location_name").alias("location_key")).agg(
        F.count(F.lit(1)).alias("readings")
    )
    joined = dimensions.location_dimension(spark).join(used, "location_key", "left")
    return joined.withColumns(
        {"readings": F.coalesce("readings", F.lit(0)), "wkt": F.col("geom.wkt")}
    ).drop("geom")


# --- merges ---------------------------------------------------------------------

CATEGORY_OUT = [
    "category_key", "category_raw", "category_label_en", "category_group", "severity_level", "severity_rank",
    "causes_road_closure",
]


@query(
    "snk_insert_if_absent",
    sql.with_(sql.POLLS, sql.DIM_CATEGORY)
    + f"SELECT {', '.join(CATEGORY_OUT)} FROM dim_incident_category UNION ALL SELECT DISTINCT "
    "lower(replace(category, ' ', '_')), category, category, 'Other', 'low', 1, FALSE FROM polls "
    "WHERE category NOT IN (SELECT category_raw FROM dim_incident_category)",
)
def snk_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories seen in the polls are added to the dimension where it lacks them."""
    seen = adapters.incident_polls(spark, sf_dir).select(
        F.lower(F.replace("category", F.lit(" "), F.lit("_"))).alias("category_key"),
        F.col("category").alias("category_raw"),
        F.col("category").alias("category_label_en"),
        F.lit("Other").alias("category_group"),
        F.lit("low").alias("severity_level"),
        F.lit(1).alias("severity_rank"),
        F.lit(False).alias("causes_road_closure"),
    )
    seed = dimensions.category_dimension(spark).select(*CATEGORY_OUT)
    return merge.insert_if_absent(seed, seen, ["category_raw"])


# --- sinks ----------------------------------------------------------------------


@query(
    "snk_landing",
    sql.with_(sql.ENRICHED.replace("SELECT * REPLACE (coalesce(congestion_ratio::DOUBLE, 1.0::DOUBLE) AS "
                                   "congestion_ratio) FROM readings", "SELECT * FROM readings"))
    + f"SELECT {sql.rounded(FLOW_COLUMNS)}, year(event_time) AS year, month(event_time) AS month, "
    "day(event_time) AS day, 'b0' AS load FROM enriched",
)
def snk_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "landing")
    writers.land(adapters.flow_readings(spark, sf_dir), lake, tables.LANDING_FLOW, "b0")
    return lake.read(tables.LANDING_FLOW)


@query(
    "snk_silver_flow",
    sql.with_(sql.ROLLUP) + f"SELECT {sql.rounded(flow.ROLLUP_COLUMNS)}, year(window_start) AS year, "
    "month(window_start) AS month, day(window_start) AS day, 'b0' AS load FROM rollup_rows",
)
def snk_silver_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "silver")
    writers.write_silver_flow(rollups.rollup(spark, sf_dir), lake, "b0")
    return lake.read(tables.SILVER_FLOW)


@query(
    "snk_silver_incidents",
    sql.with_(sql.COLLAPSED) + f"SELECT {', '.join(incidents.COLLAPSED_COLUMNS)}, year(event_time) AS year, "
    "month(event_time) AS month, day(event_time) AS day, 'b0' AS load FROM collapsed",
)
def snk_silver_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "silver")
    writers.write_silver_incidents(rollups.collapsed(spark, sf_dir), lake, "b0")
    return lake.read(tables.SILVER_INCIDENTS)


@query(
    "snk_fact_flow",
    sql.with_(sql.FLOW_FACTS) + f"SELECT {sql.rounded(keys.FLOW_FACT_COLUMNS)} FROM flow_facts "
    "WHERE date_key IS NOT NULL",
)
def snk_fact_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "facts")
    writers.load_flow_facts(rollups.rollup(spark, sf_dir), dimensions.seeded(spark), lake, "b0")
    return lake.read(tables.FACT_FLOW).select(*keys.FLOW_FACT_COLUMNS)


@query(
    "snk_fact_incidents",
    sql.with_(sql.STORED_INCIDENT_FACTS) + f"SELECT {', '.join(keys.INCIDENT_FACT_COLUMNS)} FROM stored_incidents",
)
def snk_fact_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polls run into a year after the seeded calendar: those facts are kept as well."""
    lake = new_lake(spark, "facts")
    writers.load_incident_facts(rollups.collapsed(spark, sf_dir), dimensions.seeded(spark), lake, "b0")
    return lake.read(tables.FACT_INCIDENTS).select(*keys.INCIDENT_FACT_COLUMNS)


PARTIAL = sql.ROLLUP.replace("FROM enriched GROUP BY ALL", "FROM enriched WHERE confidence_band <> 'low' GROUP BY ALL")


def _facts_sql(source: str) -> str:
    return sql.with_(sql.FLOW_FACTS.replace(sql.ROLLUP, source)) + f"SELECT {sql.rounded(keys.FLOW_FACT_COLUMNS)} "


@query(
    "snk_fact_upsert",
    "SELECT * FROM (" + _facts_sql(sql.ROLLUP) + "FROM flow_facts WHERE window_start_utc >= TIMESTAMP '2024-01-02') "
    "UNION ALL SELECT * FROM ("
    + _facts_sql(PARTIAL)
    + "FROM flow_facts WHERE window_start_utc < TIMESTAMP '2024-01-02')",
)
def snk_fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads facts without low-confidence readings, then reloads the second day from all readings."""
    lake, dims = new_lake(spark, "facts"), dimensions.seeded(spark)
    readings = rollups.enriched(spark, sf_dir)
    writers.load_flow_facts(
        flow.roll_up_readings(readings.where("confidence_band <> 'low'")), dims, lake, "first"
    )
    second_day = flow.roll_up_readings(readings).where("window_start >= TIMESTAMP '2024-01-02 00:00:00'")
    writers.load_flow_facts(second_day, dims, lake, "second")
    return lake.read(tables.FACT_FLOW).select(*keys.FLOW_FACT_COLUMNS)


@query(
    "snk_quarantine",
    sql.with_(sql.READINGS) + "SELECT location_name AS key, ts AS timestamp, CASE event_id % 50 "
    "WHEN 0 THEN 'malformed record' WHEN 1 THEN 'missing frc' WHEN 2 THEN 'malformed record' END AS reason, "
    "CASE WHEN event_id % 50 < 3 THEN ingested_at END AS ingested_at, event_id % 50 < 3 AS has_record FROM readings",
)
def snk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes all messages; every one is found again, landed (no reason) or quarantined."""
    lake = new_lake(spark, "routing")
    checked = contract.check_records(
        adapters.checked_messages(spark, sf_dir), F.col("body"), contracts.FLOW_SCHEMA, contracts.FLOW_REQUIRED
    )
    writers.route(checked, contracts.FLOW_SCHEMA, lake, tables.LANDING_FLOW, "b0")
    landed = lake.read(tables.LANDING_FLOW).select(
        "key", "timestamp", F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("long").alias("ingested_at"), F.lit(False).alias("has_record"),
    )
    # The record is kept whole, even where it does not parse.
    inside = F.regexp_extract("record", r'"ingested_at":(\d+)', 1).cast("long")
    dead = lake.read(f"{tables.QUARANTINE}/flow").select(
        "key", "timestamp", "reason", inside.alias("ingested_at"), F.col("record").isNotNull().alias("has_record")
    )
    return landed.unionByName(dead)


def land_in_loads(spark: SparkSession, sf_dir: str, lake: Lake, loads: int = 4) -> None:
    """All readings in several loads, the hours of the day dealt out among them."""
    readings = adapters.flow_readings(spark, sf_dir)
    hour = F.expr("ingested_at div 3600000")
    for n in range(loads):
        writers.land(readings.where(hour % loads == n), lake, tables.LANDING_FLOW, f"b{n}")


@query(
    "snk_compact",
    sql.with_(sql.ENRICHED.replace("SELECT * REPLACE (coalesce(congestion_ratio::DOUBLE, 1.0::DOUBLE) AS "
                                   "congestion_ratio) FROM readings", "SELECT * FROM readings"))
    + f"SELECT {sql.rounded(FLOW_COLUMNS)}, day(event_time) AS day, CASE WHEN day(event_time) = 1 THEN 'compacted-' "
    "ELSE 'b' || ((ingested_at // 3600000) % 4) END AS load FROM enriched",
)
def snk_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lands in four loads and compacts the first day; the second stays as it was."""
    lake = new_lake(spark, "compaction")
    land_in_loads(spark, sf_dir, lake)
    compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.LANDING_FLOW])
    compacted = F.col(tables.LOAD).startswith(tables.COMPACTED)
    load = F.when(compacted, tables.COMPACTED).otherwise(F.col(tables.LOAD))
    return lake.read(tables.LANDING_FLOW).select(*FLOW_COLUMNS, "day", load.alias("load"))


@query(
    "snk_compact_targets",
    "SELECT 'landing/flow' AS table_name, 'compacted' AS outcome, rows FROM ("
    + sql.with_(sql.ENRICHED) + "SELECT count(*) AS rows FROM enriched WHERE day(event_time) = 1) "
    "UNION ALL SELECT 'landing/incidents', 'compacted', rows FROM ("
    + sql.with_(sql.POLLS) + "SELECT count(*) AS rows FROM polls "
    "WHERE date_trunc('day', make_timestamp(ingested_at * 1000)) = DATE '2024-01-01') "
    "UNION ALL SELECT 'silver/flow', 'compacted', rows FROM ("
    + sql.with_(sql.ROLLUP) + "SELECT count(*) AS rows FROM rollup_rows WHERE day(window_start) = 1) "
    "UNION ALL SELECT 'silver/incidents', 'compacted', rows FROM ("
    + sql.with_(sql.COLLAPSED) + "SELECT count(*) AS rows FROM collapsed "
    "WHERE date_trunc('day', event_time) = DATE '2024-01-01')",
)
def snk_compact_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacts the day before 2024-01-02 in the landing and silver tables."""
    lake = new_lake(spark, "compaction")
    land_in_loads(spark, sf_dir, lake)
    writers.write_silver_flow(rollups.rollup(spark, sf_dir), lake, "b0")
    polls = adapters.incident_polls(spark, sf_dir)
    writers.land(polls, lake, tables.LANDING_INCIDENTS, "b0")
    writers.write_silver_incidents(incidents.collapse_polls(polls), lake, "b0")
    names = [tables.LANDING_FLOW, tables.LANDING_INCIDENTS, tables.SILVER_FLOW, tables.SILVER_INCIDENTS]
    return compaction.compact_previous_day(lake, date(2024, 1, 2), names)


# --- clustered facts ------------------------------------------------------------


@query(
    "rd_area_clustered",
    sql.with_(sql.STORED_INCIDENT_FACTS) + f"SELECT {', '.join(keys.INCIDENT_FACT_COLUMNS)} FROM stored_incidents "
    "JOIN areas ON lat BETWEEN lat0 AND lat1 AND lon BETWEEN lon0 AND lon1 WHERE area = 'alexandria'",
)
def rd_area_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents of one area, all days: of the compacted first day only files along the curve that
    may hold the area are listed, of the other days all."""
    lake = new_lake(spark, "clustered")
    writers.load_incident_facts(rollups.collapsed(spark, sf_dir), dimensions.seeded(spark), lake, "b0")
    compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.FACT_INCIDENTS], files=4)
    ((_, _, lat0, lon0, lat1, lon1),) = [a for a in codes.AREAS if a[0] == "alexandria"]
    found = lake.read_within(tables.FACT_INCIDENTS, {"lat": (lat0, lat1), "lon": (lon0, lon1)})
    return found.select(*keys.INCIDENT_FACT_COLUMNS)


@query(
    "rd_location_clustered",
    sql.with_(sql.FLOW_FACTS) + f"SELECT {sql.rounded(keys.FLOW_FACT_COLUMNS)} FROM flow_facts "
    f"WHERE location_sk = {rollups.HISTORY_OF}",
)
def rd_location_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of one location, by its name: of both compacted days only the files that may hold it."""
    lake, dims = new_lake(spark, "clustered"), dimensions.seeded(spark)
    writers.load_flow_facts(rollups.rollup(spark, sf_dir), dims, lake, "b0")
    for following in (2, 3):
        compaction.compact_previous_day(lake, date(2024, 1, following), [tables.FACT_FLOW], files=4)
    return marts.location_history(
        lambda names: lake.read_within(tables.FACT_FLOW, {"location_name": (min(names), max(names))}),
        dimensions.location_dimension(spark), rollups.HISTORY_OF,
    ).select(*keys.FLOW_FACT_COLUMNS)


# --- figures observed while loads are written ------------------------------------


@query(
    "agg_load_metrics",
    sql.with_(sql.READINGS) + "SELECT 'b' || ((ingested_at // 3600000) % 4) AS load, count(*) AS row_count, "
    "count(*) FILTER (WHERE road_closed) AS closed_rows, min(ingested_at) AS first_ingested_at, "
    "max(ingested_at) AS last_ingested_at FROM readings GROUP BY ALL",
)
def agg_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, closures and times of each load, as its write observed them: nothing is read back."""
    lake = new_lake(spark, "metrics")
    land_in_loads(spark, sf_dir, lake)
    rows = [
        (x.load, *(x.observed[n] for n in ("rows", "closed_rows", "first_ingested_at", "last_ingested_at")))
        for x in lake.snapshot(tables.LANDING_FLOW).loads
    ]
    return spark.createDataFrame(rows, "load string, row_count long, closed_rows long, first_ingested_at long, last_ingested_at long")


def _stored_checks_sql() -> str:
    source = {"fact_traffic_flow": (sql.FLOW_FACTS, "flow_facts WHERE date_key IS NOT NULL"),
              "fact_incidents": (sql.STORED_INCIDENT_FACTS, "stored_incidents")}
    parts = []
    for table, (context, rows) in source.items():
        checks = [(f"not_null({c})", f"{c} IS NULL") for c in quality.NOT_NULL[table]]
        checks += [(f"range({c})", f"NOT ({ok})") for c, ok in quality.RANGES.get(table, {}).items()]
        checks += [(f"length({c})", f"length({c}) > {n}") for c, n in quality.TEXT_LENGTHS[table].items()]
        checks += [(f"smallint({c})", f"{c} NOT BETWEEN -32768 AND 32767") for c in quality.SMALL_INTEGERS[table]]
        counts = ", ".join(f"count(*) FILTER (WHERE {bad}) AS c{i}" for i, (_, bad) in enumerate(checks))
        names = ", ".join(f"'{rule}'" for rule, _ in checks)
        values = ", ".join(f"c{i}" for i in range(len(checks)))
        parts.append(
            f"SELECT unnest([{names}]) AS rule, '{table}' AS table_name, unnest([{values}]) AS violations FROM ("
            + sql.with_(context) + f"SELECT {counts} FROM {rows})"
        )
    return " UNION ALL ".join(parts)


@query("dq_stored_loads", _stored_checks_sql())
def dq_stored_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of single rows over both stored fact tables, summed from their loads' figures."""
    lake = rollups.stored_facts(spark, sf_dir)
    rows = [
        (rule, table.rsplit("/", 1)[-1], violations)
        for table in (tables.FACT_FLOW, tables.FACT_INCIDENTS)
        for rule, violations in tables.table_figures(lake, table).items()
        if rule != "rows"
    ]
    return spark.createDataFrame(rows, "rule string, table_name string, violations long")
