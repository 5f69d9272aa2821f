"""SQL fragments that state, over the same tables, what the adapters and rollups give.

Written for DuckDB as an independent check. Each constant is one or more common
table expressions; ``with_`` chains them.
"""

from __future__ import annotations

from roadlake.functions import codes
from roadlake.sources import adapters


def text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"{value!r}::DOUBLE"
    return str(value)


def values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


PLACES = values("places", "li, place, plat, plon", [(i, *p) for i, p in enumerate(adapters.PLACES)])
CITIES = values("cities", "place_key, place_city", list(codes.CITY_OF_PLACE.items()))
CLASSES = values("classes", "class_code, class_label", list(codes.ROAD_CLASSES.items()))
MAGNITUDES = values("magnitudes", "mag_code, mag_label", list(codes.MAGNITUDES.items()))
CATEGORY_NAMES = values("category_names", "cat_id, cat_name", list(codes.CATEGORIES.items()))
POLLED = values("polled", "slot, polled_name, polled_id", [(i, n, c) for i, (c, n) in enumerate(adapters.POLLED)])
AREAS = values(
    "areas", "pos, area, area_city, lat0, lon0, lat1, lon1", [(i, *a) for i, a in enumerate(codes.AREAS)]
)

READINGS = PLACES + f""",
ev1 AS (SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) // 1000 AS ms,
               CAST(user_id % {len(adapters.PLACES)} AS INTEGER) AS li FROM events),
ev2 AS (SELECT *, CASE WHEN event_id % 13 = 0 THEN 0 ELSE 40 + 2 * li END AS ff FROM ev1),
ev3 AS (SELECT *, CASE WHEN ff = 0 THEN 0 ELSE least(ff, CAST(floor(value) AS INTEGER)) END AS cs FROM ev2),
readings AS (
  SELECT event_id, ts,
    {adapters.FLOW_EPOCH_MS} + (ms - {adapters.FLOW_EPOCH_MS}) // {adapters.TIME_SQUEEZE} AS ingested_at,
    place AS location_name, plat AS query_lat, plon AS query_lon,
    CASE WHEN event_id % 5 <> 0 THEN plat + 0.001::DOUBLE END AS segment_lat,
    CASE WHEN event_id % 5 <> 0 THEN plon + 0.001::DOUBLE END AS segment_lon,
    'FRC' || (user_id % 8) AS frc,
    cs AS current_speed_kmh, ff AS free_flow_speed_kmh,
    CASE WHEN cs = 0 THEN 600 ELSE ((60 + li) * ff) // cs END AS current_travel_time,
    60 + li AS free_flow_travel_time,
    CAST((event_id % 11) / 10.0 AS FLOAT) AS confidence,
    event_type = 'error' AND event_id % 3 = 0 AS road_closed,
    CASE WHEN ff > 0 THEN CAST(round_even(cs::DOUBLE / ff, 3) AS FLOAT) END AS congestion_ratio
  FROM ev3 JOIN places USING (li))"""

ENRICHED = READINGS + ",\n" + CITIES + ",\n" + CLASSES + """,
filled AS (SELECT * REPLACE (coalesce(congestion_ratio::DOUBLE, 1.0::DOUBLE) AS congestion_ratio) FROM readings),
enriched AS (
  SELECT r.*,
    make_timestamp((ingested_at // 1000) * 1000000) AS event_time,
    coalesce(segment_lat, query_lat) AS lat, coalesce(segment_lon, query_lon) AS lon,
    coalesce(place_city, 'unknown') AS city,
    coalesce(class_label, 'Unknown') AS frc_label,
    CASE WHEN free_flow_speed_kmh > 0 THEN
      round((free_flow_speed_kmh - current_speed_kmh)::DOUBLE / free_flow_speed_kmh * 100, 2) END AS speed_drop_pct,
    current_travel_time - free_flow_travel_time AS travel_time_delay_seconds,
    round((current_travel_time - free_flow_travel_time) / 60.0::DOUBLE, 2) AS travel_time_delay_minutes,
    round((1.0::DOUBLE - congestion_ratio) * 100, 2) AS congestion_severity_score,
    CASE WHEN road_closed THEN 'road_closed'
         WHEN congestion_ratio >= 0.95::DOUBLE THEN 'free_flow'
         WHEN congestion_ratio >= 0.75::DOUBLE THEN 'light'
         WHEN congestion_ratio >= 0.50::DOUBLE THEN 'moderate'
         ELSE 'heavy' END AS congestion_level,
    CASE WHEN confidence::DOUBLE >= 0.8::DOUBLE THEN 'high'
         WHEN confidence::DOUBLE >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS confidence_band
  FROM filled r LEFT JOIN cities ON location_name = place_key LEFT JOIN classes ON frc = class_code)"""

WINDOW_OF = "make_timestamp((epoch_us(event_time) // 900000000) * 900000000)"


def earliest(column: str) -> str:
    return f"arg_min({column}, {{'t': event_time, 'v': {column}}}) FILTER (WHERE {column} IS NOT NULL)"


AVERAGE_SQL = """
    avg(current_speed_kmh) AS avg_speed_kmh, avg(free_flow_speed_kmh) AS avg_free_flow_kmh,
    avg(congestion_ratio) AS avg_congestion_ratio, avg(current_travel_time) AS avg_travel_time_seconds,
    avg(free_flow_travel_time) AS avg_free_flow_travel_time_seconds,
    avg(travel_time_delay_seconds) AS avg_travel_time_delay_seconds,
    avg(travel_time_delay_minutes) AS avg_travel_time_delay_minutes,
    avg(speed_drop_pct) AS avg_speed_drop_pct,
    avg(congestion_severity_score) AS avg_congestion_severity_score,
    avg(confidence::DOUBLE) AS avg_confidence"""
EXTREME_SQL = """
    min(current_speed_kmh) AS min_speed_kmh, max(current_speed_kmh) AS max_speed_kmh,
    min(congestion_ratio) AS min_congestion_ratio, max(congestion_ratio) AS max_congestion_ratio"""
CARRIED_SQL = f"""
    {earliest('frc')} AS frc_code, {earliest('congestion_level')} AS congestion_level,
    {earliest('confidence_band')} AS confidence_band, {earliest('road_closed')} AS road_closed_flag,
    {earliest('lat')} AS lat, {earliest('lon')} AS lon"""

ROLLUP = ENRICHED + f""",
rolled AS (
  SELECT location_name, city, {WINDOW_OF} AS window_start, {WINDOW_OF} + INTERVAL 15 MINUTE AS window_end,
    {AVERAGE_SQL}, {EXTREME_SQL}, {CARRIED_SQL}, count(*) AS sample_count
  FROM enriched GROUP BY ALL),
rollup_rows AS (SELECT rolled.*, coalesce(class_label, 'Unknown') AS frc_label
            FROM rolled LEFT JOIN classes ON frc_code = class_code)"""

# The incidents.
POLL_SECONDS = f"{adapters.POLL_EPOCH_S} + (o_orderkey % 1100) * 86400 + (o_orderkey % 96) * 900"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), {ISO})"


POLLS = AREAS + ",\n" + POLLED + f""",
po1 AS (SELECT l_linenumber, l_quantity, l_extendedprice, o_orderkey AS k, o_custkey AS cust, {POLL_SECONDS} AS t
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
polls AS (
  SELECT (t + (l_linenumber - 1) * 360) * 1000 + 123 AS ingested_at,
    area AS bbox_name, polled_name AS category, polled_id AS icon_category_id,
    CAST(trunc(l_quantity) AS INTEGER) % 6 AS magnitude,
    CASE WHEN k % 9 <> 0 THEN 'P' || (cust % 50) END AS from_location,
    CASE WHEN k % 10 <> 0 THEN 'Q' || (cust % 40) END AS to_location,
    CAST(trunc(l_quantity) AS INTEGER) * 30 AS delay_seconds,
    CAST(floor(l_extendedprice) AS INTEGER) AS length_meters,
    CASE WHEN k % 4 <> 0 THEN 'R' || (k % 20) END AS road_numbers,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN 'n/a' ELSE {iso('t - 1800')} END AS start_time,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 13 = 0 THEN {iso('t + 360')} ELSE {iso('t + 5400')} END AS end_time,
    CASE WHEN k % 6 <> 0 THEN (lat0 + lat1) / 2 + (k % 10) * 0.001::DOUBLE END AS lat,
    CASE WHEN k % 6 <> 0 THEN (lon0 + lon1) / 2 + (k % 10) * 0.001::DOUBLE END AS lon
  FROM po1 JOIN areas ON cust % {len(codes.AREAS)} = pos JOIN polled ON k % {len(adapters.POLLED)} = slot)"""

INCIDENTS = POLLS + ",\n" + MAGNITUDES + f""",
inc1 AS (
  SELECT polls.*, make_timestamp((ingested_at // 1000) * 1000000) AS event_time,
    try_strptime(start_time, {ISO}) AS start_time_parsed, try_strptime(end_time, {ISO}) AS end_time_parsed
  FROM polls),
incidents AS (
  SELECT inc1.* EXCLUDE (ingested_at, start_time, end_time), area_city AS city,
    CASE WHEN start_time_parsed IS NOT NULL AND end_time_parsed IS NOT NULL THEN
      round((epoch_us(end_time_parsed) // 1000000 - epoch_us(start_time_parsed) // 1000000) / 60.0::DOUBLE, 2)
      END AS incident_duration_minutes,
    round(delay_seconds / 60.0::DOUBLE, 2) AS delay_minutes,
    round(length_meters / 1000.0::DOUBLE, 3) AS length_km,
    coalesce(mag_label, 'Unknown') AS magnitude_label,
    lower(category) = 'road closed' AS is_road_closure,
    lat IS NOT NULL AND lon IS NOT NULL AS has_known_location,
    CASE WHEN start_time_parsed IS NOT NULL AND end_time_parsed IS NOT NULL THEN
      event_time >= start_time_parsed AND event_time <= end_time_parsed ELSE TRUE END AS is_active
  FROM inc1 JOIN areas ON bbox_name = area LEFT JOIN magnitudes ON magnitude = mag_code)"""

CARRIED_INCIDENT = [
    "icon_category_id", "magnitude", "delay_seconds", "length_meters", "road_numbers", "end_time_parsed",
    "has_known_location", "is_active", "lat", "lon", "city", "incident_duration_minutes", "delay_minutes",
    "length_km", "is_road_closure",
]
COLLAPSED = INCIDENTS + f""",
coll AS (
  SELECT bbox_name, category, from_location, to_location, start_time_parsed, {WINDOW_OF} AS window_start,
    {', '.join(f'{earliest(c)} AS {c}' for c in CARRIED_INCIDENT)}
  FROM incidents GROUP BY ALL),
collapsed AS (SELECT coll.* RENAME (window_start AS event_time), coalesce(mag_label, 'Unknown') AS magnitude_label
              FROM coll LEFT JOIN magnitudes ON magnitude = mag_code)"""

# The dimensions.
DAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def sql_list(items: list) -> str:
    return "[" + ", ".join(text(i) for i in items) + "]"


def date_dimension(days: str) -> str:
    """``dim_date`` over a relation ``days(full_date)``."""
    return f"""dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
    year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month,
    strftime(full_date, '%B') AS month_name_en,
    {sql_list(codes.MONTHS_AR)}[month(full_date)] AS month_name_ar,
    weekofyear(full_date) AS week_of_year, day(full_date) AS day_of_month, isodow(full_date) AS day_of_week,
    {sql_list(DAYS_EN)}[isodow(full_date)] AS day_name_en, {sql_list(codes.DAYS_AR)}[isodow(full_date)] AS day_name_ar,
    isodow(full_date) IN (5, 6) AS is_weekend, FALSE AS is_public_holiday, CAST(NULL AS VARCHAR) AS holiday_name,
    FALSE AS is_ramadan, FALSE AS is_school_term,
    CASE WHEN month(full_date) IN (3, 4, 5) THEN 'Spring' WHEN month(full_date) IN (6, 7, 8) THEN 'Summer'
         WHEN month(full_date) IN (9, 10, 11) THEN 'Autumn' ELSE 'Winter' END AS season,
    CASE WHEN isodow(full_date) IN (5, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM {days})"""


FIXED_DAYS = f"""fixed_days AS (SELECT CAST(unnest(generate_series(DATE '{codes.CALENDAR_FIRST_DAY}',
  DATE '{codes.CALENDAR_LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS full_date)"""
DIM_DATE = FIXED_DAYS + ",\n" + date_dimension("fixed_days")

POLL_DAYS = """poll_days AS (SELECT CAST(event_time AS DATE) AS full_date, count(*) AS polls
  FROM incidents GROUP BY ALL)"""
COVERING_DAYS = POLL_DAYS + f""",
covering_days AS (SELECT CAST(unnest(generate_series(
    least(min(full_date), DATE '{codes.CALENDAR_FIRST_DAY}'),
    greatest(max(full_date), DATE '{codes.CALENDAR_LAST_DAY}'), INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM poll_days)"""

DIM_TIME = """slots AS (SELECT CAST(unnest(range(96)) AS INTEGER) AS time_key),
dim_time AS (
  SELECT time_key, time_key // 4 AS hour, (time_key % 4) * 15 AS minute,
    lpad(CAST(time_key // 4 AS VARCHAR), 2, '0') || ':' || lpad(CAST((time_key % 4) * 15 AS VARCHAR), 2, '0')
      AS period_label,
    time_key // 4 BETWEEN 7 AND 9 AS is_peak_am, time_key // 4 BETWEEN 16 AND 19 AS is_peak_pm,
    time_key // 4 NOT BETWEEN 7 AND 9 AND time_key // 4 NOT BETWEEN 16 AND 19 AND time_key // 4 >= 5 AS is_off_peak,
    time_key // 4 < 5 AS is_overnight
  FROM slots)"""

HOLIDAYS = values(
    "holidays", "holiday_date, holiday",
    [(f"{y}-{m:02d}-{d:02d}", name) for m, d, name, years in codes.PUBLIC_HOLIDAYS for y in years],
)

DIM_CATEGORY = values(
    "dim_incident_category",
    "category_sk, category_key, category_raw, icon_category_id, category_label_en, category_label_ar, "
    "category_group, severity_level, severity_rank, causes_road_closure",
    [(i, *row) for i, row in enumerate(codes.CATEGORY_SEED, start=1)],
)

DIM_LOCATION = values(
    "location_seed", "location_sk, location_key, location_name, governorate, area_zone, frc, lat, lon",
    [(i, *row) for i, row in enumerate(codes.LOCATION_SEED, start=1)],
) + (",\n" + CLASSES + """,
dim_location AS (
  SELECT location_sk, location_key, 1 AS version_number, location_name,
    CASE governorate WHEN 'Alexandria' THEN 'alexandria' ELSE 'cairo' END AS city, governorate, area_zone,
    CASE frc WHEN 'FRC2' THEN 'arterial' WHEN 'FRC3' THEN 'local' ELSE 'highway' END AS road_type,
    frc, class_label AS frc_label, lat, lon, DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
    TRUE AS is_current
  FROM location_seed JOIN classes ON frc = class_code)""")
DIM_LOCATION_ONLY = DIM_LOCATION.replace(",\n" + CLASSES, "")  # where the classes are already defined

FLOW_KEYED = ROLLUP + ",\n" + DIM_DATE + ",\n" + DIM_TIME + ",\n" + DIM_LOCATION_ONLY + """,
flow_keyed AS (
  SELECT r.*, date_key, time_key, location_sk
  FROM rollup_rows r
  LEFT JOIN dim_date ON CAST(window_start AS DATE) = full_date
  LEFT JOIN dim_time t ON hour(window_start) = t.hour AND minute(window_start) = t.minute
  LEFT JOIN dim_location d ON r.location_name = location_key AND is_current)"""

FLOW_FACTS = FLOW_KEYED + """,
flow_facts AS (SELECT * EXCLUDE (lat, lon, city) RENAME (window_start AS window_start_utc, window_end AS window_end_utc)
  FROM flow_keyed)"""

INCIDENT_KEYED = COLLAPSED + ",\n" + DIM_DATE + ",\n" + DIM_TIME + ",\n" + DIM_LOCATION + ",\n" + DIM_CATEGORY + """,
incident_keyed AS (
  SELECT r.*, date_key, time_key, location_sk, category_sk
  FROM collapsed r
  LEFT JOIN dim_date ON CAST(event_time AS DATE) = full_date
  LEFT JOIN dim_time t ON hour(event_time) = t.hour AND (minute(event_time) // 15) * 15 = t.minute
  LEFT JOIN dim_location d ON r.bbox_name = location_key AND is_current
  LEFT JOIN dim_incident_category c ON r.category = category_raw)"""

INCIDENT_FACTS = INCIDENT_KEYED + """,
incident_facts AS (SELECT * EXCLUDE (bbox_name, city, icon_category_id)
  RENAME (event_time AS window_start_utc, start_time_parsed AS incident_start_utc,
          end_time_parsed AS incident_end_utc, is_active AS is_active_at_ingestion)
  FROM incident_keyed)"""


# As stored: plausible days beyond the seeded calendar get their key as well.
STORED_INCIDENT_FACTS = INCIDENT_FACTS + """,
stored_incidents AS (SELECT * REPLACE (CAST(strftime(window_start_utc, '%Y%m%d') AS INTEGER) AS date_key) FROM incident_facts)"""


def rounded(columns: list[str]) -> str:
    """Select list with averages, ratios and confidences rounded as ``tidy`` does."""
    return ", ".join(f"round({c}::DOUBLE, 6) AS {c}" if is_rounded(c) else c for c in columns)


def is_rounded(column: str) -> bool:
    return column.startswith(("avg_", "mean_")) or column in (
        "congestion_ratio", "confidence", "min_congestion_ratio", "max_congestion_ratio"
    )
