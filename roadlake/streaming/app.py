"""Streaming queries: routing and landing of records, rollups into silver and facts."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadlake.operators import contract, flow, incidents
from roadlake.session import stream_settings
from roadlake.sinks import lake as tables
from roadlake.sinks import writers
from roadlake.sinks.lake import Lake
from roadlake.sources import contracts, wire
from roadlake.sources.dimensions import Dimensions

# Dimensions as they are, or how to read them: then each micro-batch sees new versions.
DimensionSource = Dimensions | Callable[[], Dimensions]

EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}


def current(dims: DimensionSource) -> Dimensions:
    return dims() if callable(dims) else dims


def load_id(lake: Lake, name: str, batch_id: int) -> str:
    """Id of a micro-batch's load: the id its query's checkpoint was given, and the batch.

    A redelivered batch has the id it had; another checkpoint never repeats one.
    """
    (line,) = lake.spark.read.text(f"{lake.checkpoint(name)}/metadata").collect()
    return f"{json.loads(line.value)['id']}.{batch_id}"


def _start(rows: DataFrame, lake: Lake, name: str, write, trigger: dict) -> StreamingQuery:
    """Starts a foreachBatch query with a checkpoint of its own.

    The micro-batch is persisted while its writes run, so its source and state are
    read once; an empty one is skipped. The rows of each batch are counted as they pass
    and appear in the query's progress under its name.
    """
    rows = rows.observe(name, F.count(F.lit(1)).alias("rows"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                write(batch, load_id(lake, name, batch_id))
        finally:
            batch.unpersist()

    writer: DataStreamWriter = rows.writeStream.queryName(name).foreachBatch(each)
    writer = writer.option("checkpointLocation", lake.checkpoint(name)).trigger(**trigger)
    with stream_settings(lake.spark):
        return writer.start()


def land_stream(records: DataFrame, lake: Lake, table: str, trigger: dict = EVERY_MINUTE) -> StreamingQuery:
    """Appends records to a landing table as they come."""
    return _start(
        records, lake, "landing_" + table.rsplit("/", 1)[-1],
        lambda batch, load: writers.land(batch, lake, table, load), trigger,
    )


def response_streams(
    flow_bodies: DataFrame, incident_bodies: DataFrame, lake: Lake, trigger: dict = EVERY_MINUTE
) -> list[StreamingQuery]:
    """Lands what raw responses hold, and quarantines what does not fit, as they come."""
    return [
        _start(flow_bodies, lake, "responses_flow", lambda batch, load: writers.land_flow_responses(batch, lake, load), trigger),
        _start(incident_bodies, lake, "responses_incidents", lambda batch, load: writers.land_incident_responses(batch, lake, load), trigger),
    ]


def route_stream(
    checked: DataFrame, lake: Lake, table: str, schema: T.StructType, trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """Lands the checked messages that fit the contract and quarantines the others, in one pass."""
    source = table.rsplit("/", 1)[-1]
    return _start(
        checked, lake, "route_" + source,
        lambda batch, load: writers.route(batch, schema, lake, table, load), trigger,
    )


def load_flow_stream(
    readings: DataFrame, lake: Lake, dims: DimensionSource | None, trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """One rollup query feeds the silver table and, where dimensions are given, the facts."""
    rollup = flow.roll_up_readings(flow.enrich_readings(readings))

    def write(batch: DataFrame, load: str) -> None:
        writers.write_silver_flow(batch, lake, load)
        if dims is not None:
            writers.load_flow_facts(batch, current(dims), lake, load)

    return _start(rollup, lake, "flow_rollup", write, trigger)


def load_incident_stream(
    reports: DataFrame, lake: Lake, dims: DimensionSource | None, trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    collapsed = incidents.collapse_polls(reports)

    def write(batch: DataFrame, load: str) -> None:
        writers.write_silver_incidents(batch, lake, load)
        if dims is not None:
            writers.load_incident_facts(batch, current(dims), lake, load)

    return _start(collapsed, lake, "incident_rollup", write, trigger)


@dataclass(frozen=True)
class Feed:
    """One kind of message: its contract, and where it lands."""

    table: str
    schema: T.StructType
    required: list[str]
    zero_defaults: list[str] = field(default_factory=list)

    def check(self, messages: DataFrame, avro_schema: str | None = None) -> DataFrame:
        """Enveloped broker messages (key, value, timestamp) with record and reason."""
        split = wire.split_envelope(messages)
        known = F.col("magic") == wire.MAGIC
        if avro_schema is None:
            # What is not text of a known kind is kept as it came, in base64, and is no record.
            text = F.when(known, wire.text_of("payload"))
            kept = F.coalesce(text, F.base64("value"))
            return contract.check_records(split, kept, self.schema, self.required, self.zero_defaults)
        record = F.when(known, wire.parse_avro(F.col("payload"), avro_schema))
        return contract.check_records(
            split, F.base64("value"), self.schema, self.required, self.zero_defaults, record
        )

    def records(self, checked: DataFrame) -> DataFrame:
        return contract.accepted(checked, self.schema, "timestamp")


FLOW = Feed(tables.LANDING_FLOW, contracts.FLOW_SCHEMA, contracts.FLOW_REQUIRED)
INCIDENTS = Feed(
    tables.LANDING_INCIDENTS, contracts.INCIDENT_SCHEMA, contracts.INCIDENT_REQUIRED,
    contracts.INCIDENT_ZERO_DEFAULTS,
)


@dataclass
class App:
    """The running queries of the whole application."""

    lake: Lake
    queries: list[StreamingQuery] = field(default_factory=list)

    def await_any(self) -> None:
        """Blocks until any query ends, then stops the others: none runs on alone. Raises its error."""
        try:
            self.lake.spark.streams.awaitAnyTermination()
        finally:
            self.stop()

    def await_all(self) -> None:
        """Blocks until all queries ended; for runs over what is available now."""
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def start(
    lake: Lake, readings: DataFrame, reports: DataFrame, dims: DimensionSource | None = None,
    trigger: dict = EVERY_MINUTE,
) -> App:
    """Starts landing and rollup queries of both feeds. Without dimensions no facts are loaded."""
    app = App(lake)
    app.queries = [
        land_stream(readings, lake, tables.LANDING_FLOW, trigger),
        land_stream(reports, lake, tables.LANDING_INCIDENTS, trigger),
        load_flow_stream(readings, lake, dims, trigger),
        load_incident_stream(reports, lake, dims, trigger),
    ]
    return app


def start_from_messages(
    lake: Lake, flow_messages: DataFrame, incident_messages: DataFrame, dims: DimensionSource | None = None,
    trigger: dict = EVERY_MINUTE, flow_avro: str | None = None, incident_avro: str | None = None,
) -> App:
    """As ``start``, from broker messages: what breaks its contract is quarantined on the way."""
    flow_checked, incident_checked = FLOW.check(flow_messages, flow_avro), INCIDENTS.check(incident_messages, incident_avro)
    app = App(lake)
    app.queries = [
        route_stream(flow_checked, lake, FLOW.table, FLOW.schema, trigger),
        route_stream(incident_checked, lake, INCIDENTS.table, INCIDENTS.schema, trigger),
        load_flow_stream(FLOW.records(flow_checked), lake, dims, trigger),
        load_incident_stream(INCIDENTS.records(incident_checked), lake, dims, trigger),
    ]
    return app
