"""What is written per batch, the same for a whole table and for a micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.functions import flow, geo
from roadlake.operators import contract, keys
from roadlake.sinks import dimension_store
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import contracts, responses
from roadlake.sources.dimensions import Dimensions

LOADED = "inserted_at"
FEW_DAYS = 31  # up to as many days a landed batch is not shuffled


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows, persisted while they are counted and written (a micro-batch already is)."""
    if rows.is_cached:
        yield rows
        return
    rows = rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def land(records: DataFrame, lake: Lake, table: str, load: str) -> None:
    """Records as they came, by day of ingestion. A micro-batch, which is persisted, is dealt out to
    few files. Another batch is written where it lies, without a shuffle, unless it has many days:
    then each of its tasks would write a small file to each of them."""
    tables.write_load(lake, table, tables.with_day(records, flow.event_time()), load, gather=True, few=None if records.is_cached else FEW_DAYS)


def quarantine(rejected: DataFrame, lake: Lake, source: str, load: str) -> None:
    """Dead-letter rows of one source, by the day they failed."""
    rows = tables.with_day(rejected, F.col("failed_at"))
    tables.write_load(lake, f"{tables.QUARANTINE}/{source}", rows, load)


def route(checked: DataFrame, schema: T.StructType, lake: Lake, table: str, load: str) -> None:
    """Lands the checked messages that fit their contract and quarantines the others.

    Messages are parsed once: both writes read the persisted frame.
    """
    checked = checked.persist()
    try:
        keep = [c for c in ("key", "timestamp") if c in checked.columns]
        land(contract.accepted(checked, schema, *keep), lake, table, load)
        quarantine(contract.rejected(checked, *keep), lake, table.rsplit("/", 1)[-1], load)
    finally:
        checked.unpersist()


def land_flow_responses(bodies: DataFrame, lake: Lake, load: str) -> None:
    """Lands the readings of raw responses (see ``responses``); the other responses are quarantined."""
    with held(bodies) as rows:
        records = responses.flow_records(rows)
        tables.write_load(lake, tables.LANDING_FLOW, tables.with_day(records, flow.event_time()), load, gather=True)
        quarantine(responses.dead_letters(rows, contracts.RAW_FLOW, responses.FLOW_PART), lake, "flow", load)


def land_incident_responses(bodies: DataFrame, lake: Lake, load: str) -> None:
    """Lands the incidents of raw responses; what does not fit is quarantined, one by one."""
    with held(bodies) as rows:
        records = responses.incident_records(rows)
        tables.write_load(lake, tables.LANDING_INCIDENTS, tables.with_day(records, flow.event_time()), load, gather=True)
        quarantine(responses.incident_dead_letters(rows), lake, "incidents", load)


def write_silver_flow(rollup: DataFrame, lake: Lake, load: str) -> None:
    with held(rollup) as rows:
        rows = tables.with_day(rows, F.col("window_start"))
        tables.write_load(lake, tables.SILVER_FLOW, rows, load, "city", gather=True)


def write_silver_incidents(collapsed: DataFrame, lake: Lake, load: str) -> None:
    with held(collapsed) as rows:
        rows = tables.with_day(rows, F.col("event_time"))
        tables.write_load(lake, tables.SILVER_INCIDENTS, rows, load, "city", gather=True)


def _surrogate(identity: list[str]) -> Column:
    """Stable 64-bit key of an identity. Rows are told apart by the identity itself."""
    return F.xxhash64(F.to_json(F.struct(*identity)))


def _load_facts(
    facts: DataFrame, lake: Lake, table: str, load: str, derived: Callable[[], dict[str, Column]]
) -> int:
    """One load of a fact table, and its dead letters; the facts are computed once.

    Columns that follow from a row alone (``derived``) are added where the row is written, so they
    are neither kept nor shuffled.
    """
    number = tables.sequence(lake, table, load)
    facts = keys.with_days_to_come(facts, "window_start_utc").persist()

    def finish(rows: DataFrame) -> DataFrame:
        return rows.withColumns({**derived(), LOADED: F.current_timestamp(), tables.SEQUENCE: F.lit(number).cast("long")})

    try:
        quarantine(keys.outside_calendar(finish(facts).drop(tables.SEQUENCE)), lake, table.rsplit("/", 1)[-1], load)
        inside = keys.in_calendar(facts)
        dimension_store.add_days(lake, inside.select(F.to_date("window_start_utc").alias("full_date")).distinct())
        return tables.write_load(lake, table, inside, load, gather=True, finish=finish)
    finally:
        facts.unpersist()


def load_flow_facts(rollup: DataFrame, dims: Dimensions, lake: Lake, load: str) -> int:
    """Keyed upsert into fact_traffic_flow; a row loaded again takes the older one's place."""
    facts = keys.flow_facts(keys.resolve_flow_keys(rollup, dims), "location_name")
    return _load_facts(facts, lake, tables.FACT_FLOW, load, lambda: {"flow_sk": _surrogate(keys.FLOW_IDENTITY)})


def load_incident_facts(collapsed: DataFrame, dims: Dimensions, lake: Lake, load: str) -> int:
    """Keyed upsert into fact_incidents on window and incident identity, NULL parts equal."""
    facts = keys.incident_facts(keys.resolve_incident_keys(collapsed, dims), "bbox_name", "category")

    def derived() -> dict[str, Column]:
        return {"geom": geo.point(F.col("lat"), F.col("lon")), "incident_sk": _surrogate(keys.INCIDENT_IDENTITY)}

    return _load_facts(facts, lake, tables.FACT_INCIDENTS, load, derived)


def mirror(rows: DataFrame, table: str, jdbc: dict[str, str]) -> None:
    """Appends rows to a relational table over JDBC; needs a driver jar on the cluster.

    The relational side keeps its own keys and constraints. ``numPartitions`` in
    ``jdbc`` bounds how many tasks write at once.
    """
    rows.write.format("jdbc").options(**jdbc).option("dbtable", table).mode("append").save()
