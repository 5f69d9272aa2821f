"""Queries for streams: the tables are replayed as files and run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import sql
from roadlake.catalog.registry import query
from roadlake.catalog.storage import FLOW_COLUMNS, new_lake
from roadlake.functions import flow as flow_columns
from roadlake.operators import flow, incidents, keys
from roadlake.session import fresh_folder
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import adapters, dimensions
from roadlake.sources.streams import dated_in_order, replay_stream
from roadlake.streaming import app

NOON = "TIMESTAMP '2024-01-01 12:00:00'"
TEN = "TIMESTAMP '2024-01-01 10:00:00'"


FILE_ROWS = 500_000  # some 8 MB of polls
CORE_BYTES = 4 << 20  # what a batch holds for each core: up to half a million polls


def recorded(spark: SparkSession, rows: DataFrame) -> tuple[str, bool]:
    """Writes rows as files in time order, to be replayed, and whether a replay will take them in that order."""
    folder = fresh_folder(spark, "replay")
    in_order = rows.repartitionByRange("ingested_at").sortWithinPartitions("ingested_at")
    in_order.write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
    return folder, dated_in_order(spark, folder)


def replayed(spark: SparkSession, rows: DataFrame, files_per_trigger: int | None = None) -> DataFrame:
    """The rows as a stream in time order, in batches the cluster holds at once: windows close as it goes
    on, so state does not grow with the rows. Where files keep no order all rows are one batch."""
    folder, in_order = recorded(spark, rows)
    most = CORE_BYTES * spark.sparkContext.defaultParallelism if in_order else None
    return replay_stream(spark, folder, rows.schema, files_per_trigger, bytes_per_trigger=most)


def run_flow(lake: Lake, readings: DataFrame, dims: dimensions.Dimensions | None = None) -> None:
    app.load_flow_stream(readings, lake, dims, app.ONCE).awaitTermination()


@query("src_stream_replay", sql.with_(sql.READINGS) + f"SELECT {sql.rounded(FLOW_COLUMNS)} FROM readings")
def src_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings through a stream of one file per batch."""
    lake = new_lake(spark, "stream")
    stream = replayed(spark, adapters.flow_readings(spark, sf_dir), files_per_trigger=1)
    app.land_stream(stream, lake, tables.LANDING_FLOW, app.ONCE).awaitTermination()
    return lake.read(tables.LANDING_FLOW).select(*FLOW_COLUMNS)


CLOSED = "window_end <= (SELECT max(event_time) FROM enriched) - INTERVAL 2 MINUTE"


@query(
    "st_flow_windows",
    sql.with_(sql.ROLLUP) + f"SELECT {sql.rounded(flow.ROLLUP_COLUMNS)} FROM rollup_rows WHERE {CLOSED}",
)
def st_flow_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows a watermarked stream has closed once it saw all readings."""
    lake = new_lake(spark, "stream")
    run_flow(lake, replayed(spark, adapters.flow_readings(spark, sf_dir)))
    return lake.read(tables.SILVER_FLOW).select(*flow.ROLLUP_COLUMNS)


@query(
    "st_incident_windows",
    sql.with_(sql.COLLAPSED) + f"SELECT {', '.join(incidents.COLLAPSED_COLUMNS)} FROM collapsed "
    "WHERE event_time + INTERVAL 15 MINUTE <= (SELECT max(event_time) FROM incidents) - INTERVAL 2 MINUTE",
)
def st_incident_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "stream")
    polls = replayed(spark, adapters.incident_polls(spark, sf_dir))
    app.load_incident_stream(polls, lake, None, app.ONCE).awaitTermination()
    return lake.read(tables.SILVER_INCIDENTS).select(*incidents.COLLAPSED_COLUMNS)


IN_TIME = sql.ROLLUP.replace(
    "FROM enriched GROUP BY ALL", f"FROM enriched WHERE NOT (event_id % 7 = 0 AND event_time < {TEN}) GROUP BY ALL"
)


@query(
    "st_late_rows",
    sql.with_(IN_TIME) + f"SELECT location_name, city, window_start, window_end, sample_count FROM rollup_rows "
    f"WHERE {CLOSED}",
)
def st_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: the morning, the rest, and morning readings hours too late, which drop out."""
    lake, folder = new_lake(spark, "stream"), fresh_folder(spark, "replay")
    readings = adapters.flow_readings(spark, sf_dir, "event_id")
    at = flow_columns.event_time()
    late = (F.col("event_id") % 7 == 0) & (at < F.expr(TEN))
    morning = at < F.expr(NOON)
    for part in (morning & ~late, ~morning, late):
        readings.where(part).write.mode("append").parquet(folder)
        run_flow(lake, replay_stream(spark, folder, readings.schema))
    return lake.read(tables.SILVER_FLOW).select("location_name", "city", "window_start", "window_end", "sample_count")


@query(
    "st_restart_no_dup",
    sql.with_(sql.ROLLUP) + f"SELECT {sql.rounded(flow.ROLLUP_COLUMNS)} FROM rollup_rows WHERE {CLOSED}",
)
def st_restart_no_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: the morning, the rest, nothing new."""
    lake, folder = new_lake(spark, "stream"), fresh_folder(spark, "replay")
    readings = adapters.flow_readings(spark, sf_dir)
    morning = flow_columns.event_time() < F.expr(NOON)
    for part in (morning, ~morning, None):
        if part is not None:
            readings.where(part).write.mode("append").parquet(folder)
        run_flow(lake, replay_stream(spark, folder, readings.schema))
    return lake.read(tables.SILVER_FLOW).select(*flow.ROLLUP_COLUMNS)


@query(
    "st_fact_load",
    sql.with_(sql.FLOW_FACTS) + f"SELECT {sql.rounded(keys.FLOW_FACT_COLUMNS)} FROM flow_facts "
    "WHERE date_key IS NOT NULL AND window_end_utc <= (SELECT max(event_time) FROM enriched) - INTERVAL 2 MINUTE",
)
def st_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts from a stream whose every batch is loaded by key."""
    lake = new_lake(spark, "stream")
    run_flow(lake, replayed(spark, adapters.flow_readings(spark, sf_dir)), dimensions.seeded(spark))
    return lake.read(tables.FACT_FLOW).select(*keys.FLOW_FACT_COLUMNS)


INCIDENT_CLOSED = (
    "event_time + INTERVAL 15 MINUTE <= (SELECT max(event_time) FROM incidents) - INTERVAL 2 MINUTE"
)


@query(
    "st_app_run",
    "SELECT 'landing/flow' AS table_name, count(*) AS row_count FROM events "
    "UNION ALL SELECT 'landing/incidents', n FROM (" + sql.with_(sql.POLLS) + "SELECT count(*) AS n FROM polls) "
    "UNION ALL SELECT 'silver/flow', n FROM ("
    + sql.with_(sql.ROLLUP) + f"SELECT count(*) AS n FROM rollup_rows WHERE {CLOSED}) "
    "UNION ALL SELECT 'facts/fact_traffic_flow', n FROM ("
    + sql.with_(sql.FLOW_KEYED) + f"SELECT count(*) AS n FROM flow_keyed WHERE date_key IS NOT NULL AND {CLOSED}) "
    "UNION ALL SELECT 'silver/incidents', n FROM ("
    + sql.with_(sql.COLLAPSED) + f"SELECT count(*) AS n FROM collapsed WHERE {INCIDENT_CLOSED}) "
    "UNION ALL SELECT 'facts/fact_incidents', n FROM ("
    + sql.with_(sql.INCIDENT_KEYED)
    + f"SELECT count(*) AS n FROM incident_keyed WHERE {INCIDENT_CLOSED})",
)
def st_app_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole application over both replayed feeds; rows per table it wrote."""
    lake = new_lake(spark, "app")
    running = app.start(
        lake,
        replayed(spark, adapters.flow_readings(spark, sf_dir)),
        replayed(spark, adapters.incident_polls(spark, sf_dir)),
        dimensions.seeded(spark),
        app.ONCE,
    )
    running.await_all()
    names = [
        tables.LANDING_FLOW, tables.LANDING_INCIDENTS, tables.SILVER_FLOW, tables.SILVER_INCIDENTS,
        tables.FACT_FLOW, tables.FACT_INCIDENTS,
    ]
    counts = [
        lake.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out
