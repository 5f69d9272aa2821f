"""Queries for rollups, key lookups, marts and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import sql
from roadlake.catalog.registry import query
from roadlake.functions import flow as flow_columns
from roadlake.operators import flow, history, incidents, keys, quality
from roadlake.plans import marts
from roadlake.session import fresh_folder
from roadlake.sinks import lake as tables
from roadlake.sinks import dimension_store, writers
from roadlake.sinks.lake import Lake
from roadlake.sources import adapters, dimensions

FLOW_GROUP = ["location_name", "city", "window_start", "window_end"]


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.enrich_readings(adapters.flow_readings(spark, sf_dir))


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.roll_up_readings(enriched(spark, sf_dir))


def collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.collapse_polls(adapters.incident_polls(spark, sf_dir))


def flow_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.flow_facts(keys.resolve_flow_keys(rollup(spark, sf_dir), dimensions.seeded(spark)))


def incident_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.incident_facts(keys.resolve_incident_keys(collapsed(spark, sf_dir), dimensions.seeded(spark)))


# --- aggregations ---------------------------------------------------------------


@query("agg_flow_15m", sql.with_(sql.ROLLUP) + f"SELECT {sql.rounded(flow.ROLLUP_COLUMNS)} FROM rollup_rows")
def agg_flow_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(spark, sf_dir)


def partial_rollup(name: str, measures, output: list[str]) -> None:
    @query(name, sql.with_(sql.ROLLUP) + f"SELECT {sql.rounded(FLOW_GROUP + output)} FROM rollup_rows")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flow.roll_up(enriched(spark, sf_dir), measures()).select(*FLOW_GROUP, *output)


partial_rollup("agg_flow_avg", flow.average_measures, list(flow.AVERAGES))
partial_rollup("agg_flow_minmax", flow.extreme_measures, [*flow.MINIMA, *flow.MAXIMA])
partial_rollup("agg_flow_first", flow.carried_measures, list(flow.CARRIED))
partial_rollup("agg_flow_count", flow.count_measure, ["sample_count"])


@query(
    "agg_incident_dedup_15m",
    sql.with_(sql.COLLAPSED) + f"SELECT {', '.join(incidents.COLLAPSED_COLUMNS)} FROM collapsed",
)
def agg_incident_dedup_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(spark, sf_dir)


@query(
    "agg_row_metrics",
    sql.with_(sql.ENRICHED)
    + "SELECT year(event_time) AS year, month(event_time) AS month, day(event_time) AS day, count(*) AS row_count, "
    "count(*) FILTER (WHERE road_closed) AS closed_rows, min(ingested_at) AS first_ingested_at, "
    "max(ingested_at) AS last_ingested_at FROM enriched GROUP BY ALL",
)
def agg_row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = flow_columns.event_time()
    return (
        adapters.flow_readings(spark, sf_dir)
        .groupBy(F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if("road_closed").alias("closed_rows"),
            F.min("ingested_at").alias("first_ingested_at"),
            F.max("ingested_at").alias("last_ingested_at"),
        )
    )


# --- key lookups ----------------------------------------------------------------


@query("jn_flow_date", sql.with_(sql.FLOW_KEYED) + "SELECT location_name, window_start, date_key FROM flow_keyed")
def jn_flow_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions.seeded(spark)
    return keys.with_date_key(rollup(spark, sf_dir), dims.date, "window_start").select(
        "location_name", "window_start", "date_key"
    )


@query("jn_flow_time", sql.with_(sql.FLOW_KEYED) + "SELECT location_name, window_start, time_key FROM flow_keyed")
def jn_flow_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.with_time_key(rollup(spark, sf_dir), "window_start").select(
        "location_name", "window_start", "time_key"
    )


@query(
    "jn_flow_location", sql.with_(sql.FLOW_KEYED) + "SELECT location_name, window_start, location_sk FROM flow_keyed"
)
def jn_flow_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions.seeded(spark).lookups()
    return keys.with_location_key(rollup(spark, sf_dir), dims.location, "location_name").select(
        "location_name", "window_start", "location_sk"
    )


INCIDENT_OUT = ["bbox_name", "category", "from_location", "to_location", "event_time"]


def incident_key_query(name: str, key: str, attach) -> None:
    @query(name, sql.with_(sql.INCIDENT_KEYED) + f"SELECT {', '.join(INCIDENT_OUT)}, {key} FROM incident_keyed")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return attach(collapsed(spark, sf_dir), dimensions.seeded(spark).lookups()).select(*INCIDENT_OUT, key)


incident_key_query("jn_inc_date", "date_key", lambda rows, dims: keys.with_date_key(rows, dims.date, "event_time"))
incident_key_query("jn_inc_time", "time_key", lambda rows, dims: keys.with_time_key(rows, "event_time"))
incident_key_query(
    "jn_inc_location", "location_sk", lambda rows, dims: keys.with_location_key(rows, dims.location, "bbox_name")
)
incident_key_query("jn_inc_category", "category_sk", lambda rows, dims: keys.with_category_key(rows, dims.category))

FLOW_KEYED_OUT = [*flow.ROLLUP_COLUMNS, "date_key", "time_key", "location_sk"]
INCIDENT_KEYED_OUT = [*incidents.COLLAPSED_COLUMNS, "date_key", "time_key", "location_sk", "category_sk"]


@query("flow_keys_resolved", sql.with_(sql.FLOW_KEYED) + f"SELECT {sql.rounded(FLOW_KEYED_OUT)} FROM flow_keyed")
def flow_keys_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.resolve_flow_keys(rollup(spark, sf_dir), dimensions.seeded(spark)).select(*FLOW_KEYED_OUT)


@query(
    "incident_keys_resolved",
    sql.with_(sql.INCIDENT_KEYED) + f"SELECT {', '.join(INCIDENT_KEYED_OUT)} FROM incident_keyed",
)
def incident_keys_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = keys.resolve_incident_keys(collapsed(spark, sf_dir), dimensions.seeded(spark))
    return resolved.select(*INCIDENT_KEYED_OUT)


def _missing_members(spark: SparkSession) -> dimensions.Dimensions:
    """Dimensions with gaps a foreign-key check must find: no arterials, no hazards."""
    dims = dimensions.seeded(spark)
    return dimensions.Dimensions(
        dims.date, dims.location.where("road_type <> 'arterial'"), dims.category.where("category_group <> 'Hazard'")
    )


FK_SQL = [
    ("flow_facts", "fact_traffic_flow", "date_key", ""),
    ("flow_facts", "fact_traffic_flow", "time_key", ""),
    ("flow_facts", "fact_traffic_flow", "location_sk", "WHERE road_type <> 'arterial'"),
    ("incident_facts", "fact_incidents", "date_key", ""),
    ("incident_facts", "fact_incidents", "time_key", ""),
    ("incident_facts", "fact_incidents", "location_sk", "WHERE road_type <> 'arterial'"),
    ("incident_facts", "fact_incidents", "category_sk", "WHERE category_group <> 'Hazard'"),
]
FK_DIMENSION = {
    "date_key": "dim_date", "time_key": "dim_time", "location_sk": "dim_location",
    "category_sk": "dim_incident_category",
}


def _orphan_sql() -> str:
    parts = []
    for source, table, key, kept in FK_SQL:
        context = sql.FLOW_FACTS if source == "flow_facts" else sql.INCIDENT_FACTS
        parts.append(
            f"SELECT 'foreign_key({key})' AS rule, '{table}' AS table_name, violations FROM (" + sql.with_(context)
            + f"SELECT count(*) AS violations FROM {source} WHERE {key} IS NOT NULL AND {key} NOT IN "
            f"(SELECT {key} FROM {FK_DIMENSION[key]} {kept}))"
        )
    return " UNION ALL ".join(parts)


@query("jn_fk_orphans", _orphan_sql())
def jn_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven foreign keys of the facts, against dimensions with gaps."""
    dims = _missing_members(spark)
    shared = {"date_key": dims.date, "time_key": dimensions.time_dimension(spark), "location_sk": dims.location}
    return quality.orphan_counts(flow_facts(spark, sf_dir), "fact_traffic_flow", shared).unionByName(
        quality.orphan_counts(
            incident_facts(spark, sf_dir), "fact_incidents", {**shared, "category_sk": dims.category}
        )
    )


# --- marts ----------------------------------------------------------------------

FLOW_OUT = sql.rounded(keys.FLOW_FACT_COLUMNS)
INCIDENT_FACT_OUT = ", ".join(keys.INCIDENT_FACT_COLUMNS)
HISTORY_OF = 1  # surrogate key of the first seeded location
IN_FLOW = sql.with_(sql.FLOW_FACTS)
IN_INCIDENTS = sql.with_(sql.STORED_INCIDENT_FACTS)
_stored: dict[tuple[str, str], Lake] = {}


def stored_facts(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with both fact tables, loaded once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        lake = Lake(spark, fresh_folder(spark, "facts"))
        writers.load_flow_facts(rollup(spark, sf_dir), dimensions.seeded(spark), lake, "b0")
        writers.load_incident_facts(collapsed(spark, sf_dir), dimensions.seeded(spark), lake, "b0")
        _stored[key] = lake
    return _stored[key]


def stored_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_facts(spark, sf_dir).read(tables.FACT_FLOW)


def stored_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_facts(spark, sf_dir).read(tables.FACT_INCIDENTS)


@query(
    "rd_latest_windows",
    IN_FLOW + f"SELECT {FLOW_OUT} FROM flow_facts "
    f"ORDER BY window_start_utc DESC, location_sk ASC NULLS FIRST LIMIT {marts.LATEST}",
)
def rd_latest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = stored_facts(spark, sf_dir)
    since = tables.certain_since(lake.snapshot(tables.FACT_FLOW), marts.LATEST)
    newest = marts.latest_windows(lake.read(tables.FACT_FLOW), since)
    return newest.select(*keys.FLOW_FACT_COLUMNS)


@query("rd_flow_by_location", IN_FLOW + f"SELECT {FLOW_OUT} FROM flow_facts WHERE location_sk = {HISTORY_OF}")
def rd_flow_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    history_of = marts.location_history(lambda names: stored_flow(spark, sf_dir), dimensions.location_dimension(spark), HISTORY_OF)
    return history_of.select(*keys.FLOW_FACT_COLUMNS)


@query(
    "rd_flow_date_location",
    IN_FLOW + "SELECT date_key, location_sk, count(*) AS windows, CAST(sum(sample_count) AS BIGINT) AS readings, "
    "round(avg(avg_speed_kmh), 6) AS mean_avg_speed_kmh, min(min_speed_kmh) AS min_speed_kmh, "
    "max(max_speed_kmh) AS max_speed_kmh, round(avg(avg_congestion_ratio), 6) AS mean_avg_congestion_ratio "
    "FROM flow_facts GROUP BY date_key, location_sk",
)
def rd_flow_date_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.flow_by_date_location(stored_flow(spark, sf_dir))


@query(
    "rd_flow_by_level",
    IN_FLOW + "SELECT congestion_level, count(*) AS windows, round(avg(avg_speed_kmh), 6) AS mean_avg_speed_kmh, "
    "round(avg(avg_travel_time_delay_minutes), 6) AS mean_avg_travel_time_delay_minutes "
    "FROM flow_facts GROUP BY congestion_level",
)
def rd_flow_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.flow_by_level(stored_flow(spark, sf_dir))


@query(
    "rd_active_incidents",
    IN_INCIDENTS + f"SELECT {INCIDENT_FACT_OUT} FROM stored_incidents WHERE is_active_at_ingestion "
    "ORDER BY window_start_utc DESC",
)
def rd_active_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.active_incidents(stored_incidents(spark, sf_dir)).select(*keys.INCIDENT_FACT_COLUMNS)


@query(
    "rd_inc_by_location",
    IN_INCIDENTS + "SELECT location_sk, count(*) AS incidents, CAST(sum(delay_seconds) AS BIGINT) AS delay_seconds "
    "FROM stored_incidents GROUP BY location_sk",
)
def rd_inc_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.incidents_by_location(stored_incidents(spark, sf_dir))


@query(
    "rd_inc_by_category",
    IN_INCIDENTS + "SELECT coalesce(category_label_en, 'Unknown') AS category_label_en, "
    "coalesce(category_group, 'Other') AS category_group, coalesce(severity_level, 'low') AS severity_level, "
    "coalesce(severity_rank, 1) AS severity_rank, count(*) AS incidents, "
    "CAST(sum(delay_seconds) AS BIGINT) AS delay_seconds, count(*) FILTER (WHERE is_road_closure) AS closures "
    "FROM stored_incidents LEFT JOIN dim_incident_category USING (category_sk) GROUP BY ALL",
)
def rd_inc_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.incidents_by_category(stored_incidents(spark, sf_dir), dimensions.category_dimension(spark))


@query(
    "rd_inc_date_location",
    IN_INCIDENTS + "SELECT date_key, location_sk, count(*) AS incidents, "
    "count(*) FILTER (WHERE is_road_closure) AS closures FROM stored_incidents GROUP BY date_key, location_sk",
)
def rd_inc_date_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.incidents_by_date_location(stored_incidents(spark, sf_dir))


@query(
    "rd_inc_by_magnitude",
    IN_INCIDENTS + "SELECT magnitude, magnitude_label, count(*) AS incidents, "
    "round(avg(delay_minutes), 6) AS mean_delay_minutes, round(avg(length_km), 6) AS mean_length_km "
    "FROM stored_incidents GROUP BY magnitude, magnitude_label",
)
def rd_inc_by_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.incidents_by_magnitude(stored_incidents(spark, sf_dir))


@query(
    "rd_points_in_area",
    IN_INCIDENTS + "SELECT area, count(*) AS incidents, count(*) FILTER (WHERE is_road_closure) AS closures "
    "FROM stored_incidents JOIN areas ON lat BETWEEN lat0 AND lat1 AND lon BETWEEN lon0 AND lon1 GROUP BY area",
)
def rd_points_in_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.incidents_in_area(stored_incidents(spark, sf_dir))


# --- quality checks -------------------------------------------------------------


def checked_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The fact tables before their contract is enforced, and the dimensions they meet."""
    dims = dimensions.seeded(spark)
    return {
        "dim_date": dims.date,
        "dim_time": dimensions.time_dimension(spark),
        "dim_location": dims.location,
        "dim_incident_category": dims.category,
        "fact_traffic_flow": flow_facts(spark, sf_dir),
        "fact_incidents": incident_facts(spark, sf_dir),
    }


SQL_TABLE = {"fact_traffic_flow": "flow_facts", "fact_incidents": "incident_facts"}
DIMS_SQL = ",\n".join([sql.DIM_DATE, sql.DIM_TIME, sql.DIM_LOCATION, sql.DIM_CATEGORY])
CONTEXT = {"fact_traffic_flow": sql.FLOW_FACTS, "fact_incidents": sql.INCIDENT_FACTS}


def _checks_sql(checks: list[tuple[str, str, str]]) -> str:
    """(table, rule, violated condition) -> one SELECT per check, grouped by table context."""
    parts = []
    for table, rule, bad in checks:
        source = SQL_TABLE.get(table, table)
        parts.append(
            f"SELECT '{rule}' AS rule, '{table}' AS table_name, violations FROM ("
            + sql.with_(CONTEXT.get(table, DIMS_SQL))
            + f"SELECT count(*) FILTER (WHERE {bad}) AS violations FROM {source})"
        )
    return " UNION ALL ".join(parts)


def _unique_sql() -> str:
    parts = []
    for table, key_sets in quality.UNIQUE.items():
        for columns in key_sets:
            known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
            parts.append(
                f"SELECT 'unique({', '.join(columns)})' AS rule, '{table}' AS table_name, violations FROM ("
                + sql.with_(CONTEXT.get(table, DIMS_SQL))
                + f"SELECT count(*) AS violations FROM (SELECT 1 FROM {SQL_TABLE.get(table, table)} WHERE {known} "
                f"GROUP BY {', '.join(columns)} HAVING count(*) > 1))"
            )
    parts.append(
        "SELECT 'unique(location_name, ingested_at)' AS rule, 'flow_readings' AS table_name, violations FROM ("
        + sql.with_(sql.READINGS)
        + "SELECT count(*) AS violations FROM (SELECT 1 FROM readings GROUP BY location_name, ingested_at "
        "HAVING count(*) > 1))"
    )
    parts.append(
        "SELECT 'unique(bbox_name, ingested_at)' AS rule, 'incident_polls' AS table_name, violations FROM ("
        + sql.with_(sql.POLLS)
        + "SELECT count(*) AS violations FROM (SELECT 1 FROM polls GROUP BY bbox_name, ingested_at "
        "HAVING count(*) > 1))"
    )
    return " UNION ALL ".join(parts)


@query("dq_unique", _unique_sql())
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = checked_tables(spark, sf_dir)
    parts = [
        quality.duplicate_keys(tables[table], table, columns)
        for table, key_sets in quality.UNIQUE.items()
        for columns in key_sets
    ]
    readings, polls = adapters.flow_readings(spark, sf_dir), adapters.incident_polls(spark, sf_dir)
    parts.append(quality.duplicate_keys(readings, "flow_readings", ["location_name", "ingested_at"]))
    parts.append(quality.duplicate_keys(polls, "incident_polls", ["bbox_name", "ingested_at"]))
    return quality.union_all(parts)


@query(
    "dq_not_null",
    _checks_sql([(t, f"not_null({c})", f"{c} IS NULL") for t, cols in quality.NOT_NULL.items() for c in cols]),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = checked_tables(spark, sf_dir)
    return quality.union_all([quality.null_violations(tables[t], t, cols) for t, cols in quality.NOT_NULL.items()])


@query(
    "dq_ranges",
    _checks_sql([(t, f"range({c})", f"NOT ({ok})") for t, rules in quality.RANGES.items() for c, ok in rules.items()]),
)
def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = checked_tables(spark, sf_dir)
    return quality.union_all([quality.range_violations(tables[t], t, rules) for t, rules in quality.RANGES.items()])


@query(
    "dq_capacity",
    _checks_sql(
        [(t, f"length({c})", f"length({c}) > {n}") for t, cols in quality.TEXT_LENGTHS.items() for c, n in cols.items()]
        + [
            (t, f"smallint({c})", f"{c} NOT BETWEEN -32768 AND 32767")
            for t, cols in quality.SMALL_INTEGERS.items()
            for c in cols
        ]
    ),
)
def dq_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = checked_tables(spark, sf_dir)
    return quality.union_all(
        [
            quality.capacity_violations(
                tables[t], t, quality.TEXT_LENGTHS.get(t, {}), quality.SMALL_INTEGERS.get(t, [])
            )
            for t in quality.TEXT_LENGTHS
        ]
    )


# --- versioned locations --------------------------------------------------------


def observed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road class last seen at each location, and the day it was seen."""
    last = (
        adapters.flow_readings(spark, sf_dir)
        .groupBy("location_name")
        .agg(F.max(F.struct("ingested_at", "frc")).alias("last"))
    )
    return last.select(
        F.col("location_name").alias("location_key"),
        F.col("last.frc").alias("frc"),
        F.to_date(F.timestamp_millis(F.col("last.ingested_at"))).alias("effective_date"),
    )


def rolled_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.roll_versions(dimensions.location_dimension(spark), observed_classes(spark, sf_dir), tracked=["frc"])


OBSERVED = f"""observed AS (
  SELECT location_name AS location_key, max(frc) AS new_frc,
    max(CAST(make_timestamp(ingested_at * 1000) AS DATE)) AS effective_date
  FROM (SELECT *, max(ingested_at) OVER (PARTITION BY location_name) AS last_seen FROM readings)
  WHERE ingested_at = last_seen GROUP BY location_name)"""
ROLLED = sql.READINGS + ",\n" + sql.DIM_LOCATION + ",\n" + OBSERVED + """,
paired AS (SELECT d.*, new_frc, effective_date, new_frc IS DISTINCT FROM frc AND new_frc IS NOT NULL
             AND effective_date > valid_from AS changed
           FROM dim_location d LEFT JOIN observed o USING (location_key)),
rolled_locations AS (
  SELECT location_sk, location_key, version_number, location_name, city, governorate, area_zone, road_type, frc,
    frc_label, lat, lon, valid_from,
    CASE WHEN changed THEN effective_date ELSE valid_to END AS valid_to, NOT changed AS is_current FROM paired
  UNION ALL
  SELECT NULL, location_key, version_number + 1, location_name, city, governorate, area_zone,
    CASE new_frc WHEN 'FRC0' THEN 'highway' WHEN 'FRC1' THEN 'highway' WHEN 'FRC2' THEN 'arterial' ELSE 'local' END,
    new_frc, coalesce(class_label, 'Unknown'), lat, lon, effective_date, NULL, TRUE
  FROM paired LEFT JOIN classes ON new_frc = class_code WHERE changed)"""
# New versions have a hashed key, which SQL leaves out.
ROLLED_SK = "CASE WHEN version_number = 1 THEN location_sk END AS location_sk"
ROLLED_OUT = [
    "location_key", "version_number", "location_name", "city", "governorate", "area_zone", "road_type", "frc",
    "frc_label", "lat", "lon", "valid_from", "valid_to", "is_current",
]


@query("scd_location_roll", sql.with_(ROLLED) + f"SELECT {ROLLED_SK}, {', '.join(ROLLED_OUT)} FROM rolled_locations")
def scd_location_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled_locations(spark, sf_dir).selectExpr(ROLLED_SK, *ROLLED_OUT)


@query("scd_stored_roll", sql.with_(ROLLED) + f"SELECT {ROLLED_SK}, {', '.join(ROLLED_OUT)} FROM rolled_locations")
def scd_stored_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored dimension after a roll by the classes observed last, read back; rolled twice, the second changes nothing."""
    lake = Lake(spark, fresh_folder(spark, "roll"))
    dimension_store.bootstrap(lake)
    for _ in range(2):
        dimension_store.roll_locations(lake, observed_classes(spark, sf_dir))
    return dimensions.stored(spark, dimension_store.folder(lake)).location.selectExpr(ROLLED_SK, *ROLLED_OUT)


@query(
    "flt_current_dim", sql.with_(ROLLED) + f"SELECT {ROLLED_SK}, {', '.join(ROLLED_OUT)} FROM rolled_locations WHERE is_current"
)
def flt_current_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.current_versions(rolled_locations(spark, sf_dir)).selectExpr(ROLLED_SK, *ROLLED_OUT)


@query(
    "dq_scd_current",
    sql.with_(ROLLED)
    + "SELECT 'one_current_version' AS rule, 'dim_location' AS table_name, (SELECT count(*) FROM (SELECT 1 FROM "
    "rolled_locations WHERE is_current GROUP BY location_key HAVING count(*) > 1)) AS violations "
    "UNION ALL SELECT 'no_overlap', 'dim_location', (SELECT count(*) FROM (SELECT *, "
    "max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY location_key ORDER BY valid_from, version_number "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached, count(*) OVER (PARTITION BY location_key, version_number) AS times "
    "FROM rolled_locations) v WHERE reached > valid_from OR times > 1 OR (version_number > 1 AND NOT EXISTS "
    "(SELECT 1 FROM rolled_locations b WHERE b.location_key = v.location_key AND b.version_number = v.version_number - 1)))",
)
def dq_scd_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations = rolled_locations(spark, sf_dir)
    single = quality.duplicate_keys(locations.where("is_current"), "dim_location", ["location_key"])
    overlap = history.overlapping_versions(locations).agg(F.count(F.lit(1)).alias("violations"))
    return single.withColumn("rule", F.lit("one_current_version")).unionByName(
        overlap.select(F.lit("no_overlap").alias("rule"), F.lit("dim_location").alias("table_name"), "violations")
    )
