"""Command line: ``python -m roadlake dimensions|roll|stream|compact --lake FOLDER ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roadlake.session import RUNTIME_CONF, STARTUP_CONF, STREAMING_CONF
from roadlake.sinks import compaction, dimension_store
from roadlake.sinks.lake import Lake
from roadlake.sources import dimensions
from roadlake.sources.streams import topic_stream
from roadlake.streaming import app


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roadlake")
    commands = parser.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--lake", required=True, help="folder of the tables, reachable by all executors")
    commands.add_parser("dimensions", parents=[common], help="store the seeded dimensions where rows are missing")

    roll = commands.add_parser("roll", parents=[common], help="open new versions of stored locations")
    roll.add_argument("--observed", required=True, help="Parquet: location_key, effective_date, tracked columns")

    stream = commands.add_parser("stream", parents=[common], help="run landing and rollup queries on broker topics")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--flow-topic", default="traffic-flow")
    stream.add_argument("--incident-topic", default="traffic-incidents")
    stream.add_argument("--flow-avro", help="file with the Avro schema of flow payloads; JSON without it")
    stream.add_argument("--incident-avro", help="file with the Avro schema of incident payloads; JSON without it")
    stream.add_argument("--max-records", type=int, default=0, help="cap per trigger; 0, the default, for none")
    stream.add_argument("--no-facts", action="store_true", help="stop at the silver tables")

    compact = commands.add_parser("compact", parents=[common], help="compact the previous day")
    compact.add_argument("--today", type=date.fromisoformat, help="run as on this day")
    compact.add_argument("--files", type=int, default=0, help="write tasks; 0, the default, sizes files by bytes")
    compact.add_argument("--keep-seconds", type=float, default=3600, help="leave replaced files to their readers for so long")
    return parser.parse_args(argv)


def _text(path: str | None) -> str | None:
    if path is None:
        return None
    with open(path, encoding="utf-8") as source:
        return source.read()


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"roadlake-{args.command}")
    for key, value in {**RUNTIME_CONF, **STARTUP_CONF, **STREAMING_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    lake = Lake(spark, args.lake.rstrip("/"))
    if args.command == "dimensions":
        dimension_store.bootstrap(lake)
    elif args.command == "roll":
        dimension_store.roll_locations(lake, spark.read.parquet(args.observed))
    elif args.command == "compact":
        outcomes = compaction.compact_previous_day(lake, args.today, files=args.files or None, keep_seconds=args.keep_seconds)
        outcomes.show(len(compaction.tables.COMPACTED_TABLES), truncate=False)
        if not outcomes.where(F.col("outcome").startswith(compaction.FAILED)).isEmpty():
            raise SystemExit(1)
    else:
        topics = [
            topic_stream(spark, args.servers, topic, args.max_records or None)
            for topic in (args.flow_topic, args.incident_topic)
        ]
        dims = None if args.no_facts else lambda: dimensions.stored(spark, dimension_store.folder(lake))
        app.start_from_messages(
            lake, *topics, dims, flow_avro=_text(args.flow_avro), incident_avro=_text(args.incident_avro)
        ).await_any()


if __name__ == "__main__":
    main()
