"""Writers, upserts, compaction and streams: repeatable, complete, recoverable."""

import re
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadlake.catalog import rollups
from roadlake.catalog.storage import land_in_loads
from roadlake.catalog.streams import replayed
from roadlake.operators import contract, flow
from roadlake.session import fresh_folder
from roadlake.sinks import compaction, dimension_store, writers
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import adapters, contracts, dimensions
from roadlake.sources.streams import replay_stream
from roadlake.streaming import app

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark):
    return Lake(spark, fresh_folder(spark, "test"))


def files(frame):
    return frame.select(F.input_file_name()).distinct().count()


def without(frame, *columns):
    return frame.drop(*columns)


def test_repeating_a_load_changes_nothing(spark, lake):
    readings = adapters.flow_readings(spark, SMALL)
    for _ in range(2):
        writers.land(readings, lake, tables.LANDING_FLOW, "b0")
    landed = lake.read(tables.LANDING_FLOW)
    assert landed.count() == readings.count()
    assert landed.select(*readings.columns).exceptAll(readings).isEmpty()


def test_partition_filter_prunes_folders(spark, lake):
    writers.land(adapters.flow_readings(spark, SMALL), lake, tables.LANDING_FLOW, "b0")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # or the plan's text is cut short
    try:
        day = lake.read(tables.LANDING_FLOW).where("year = 2024 AND month = 1 AND day = 2")
        plan = day._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert filters and all(f"isnotnull({level}" in filters[1] for level in ("year", "month", "day"))


def test_fact_reload_replaces(spark, lake):
    rolled = rollups.rollup(spark, SMALL).persist()
    dims = dimensions.seeded(spark)
    n = writers.load_flow_facts(rolled, dims, lake, "b0")
    before = without(lake.read(tables.FACT_FLOW), tables.LOAD, writers.LOADED).toPandas()
    assert n == rolled.count() == len(before)
    writers.load_flow_facts(rolled, dims, lake, "b0")
    writers.load_flow_facts(rolled.withColumn("avg_speed_kmh", F.lit(1.0)), dims, lake, "b1")
    after = lake.read(tables.FACT_FLOW)
    assert after.count() == n
    assert after.where("avg_speed_kmh <> 1.0").isEmpty()
    rolled.unpersist()


def test_upsert_leaves_other_partitions_alone(spark, lake):
    rolled = rollups.rollup(spark, SMALL)
    dims = dimensions.seeded(spark)
    writers.load_flow_facts(rolled, dims, lake, "b0")
    first_day = "date_key = 20240101"
    paths = lake.read(tables.FACT_FLOW).where(first_day).select(F.input_file_name()).distinct().collect()
    writers.load_flow_facts(rolled.where("window_start >= TIMESTAMP '2024-01-02'"), dims, lake, "b1")
    assert lake.read(tables.FACT_FLOW).where(first_day).select(F.input_file_name()).distinct().collect() == paths


def landed(lake):
    return sorted(map(tuple, lake.read(tables.LANDING_FLOW).drop(tables.LOAD).toPandas().astype(str).values.tolist()))


def compact_day(lake, day=2):
    return compaction.compact_previous_day(lake, date(2024, 1, day), [tables.LANDING_FLOW]).first()


def test_load_that_lands_during_compaction_stays(spark, lake, monkeypatch):
    land_in_loads(spark, SMALL, lake)
    late = adapters.flow_readings(spark, SMALL).orderBy("ingested_at").limit(10)
    real = tables._record

    def land_first(*args):
        writers.land(late, lake, tables.LANDING_FLOW, "late")
        real(*args)

    monkeypatch.setattr(tables, "_record", land_first)
    assert compact_day(lake).outcome == "compacted"
    assert len(landed(lake)) == adapters.flow_readings(spark, SMALL).count() + 10


@pytest.mark.parametrize("crash_at", ["record", "remove"])
def test_crashed_compaction_loses_and_doubles_nothing(spark, lake, monkeypatch, crash_at):
    """Before the record the old loads count, after it the new one; the next night's run cleans up."""
    land_in_loads(spark, SMALL, lake)
    before = landed(lake)

    def crash(*args):
        raise RuntimeError("crash")

    name = "_record" if crash_at == "record" else "_remove_loads"
    real = getattr(tables, name)
    calls = []
    # The first removal of a run is of unrecorded copies, of which there are none yet.
    monkeypatch.setattr(tables, name, lambda *a: crash() if name == "_record" or len(calls) else calls.append(a))
    assert compact_day(lake).outcome == "failed: crash"
    assert landed(lake) == before
    monkeypatch.setattr(tables, name, real)
    assert compact_day(lake, 3).outcome == "compacted" and landed(lake) == before
    assert compact_day(lake, 2).outcome == "compacted" and landed(lake) == before
    stored = spark.read.parquet(lake.path(tables.LANDING_FLOW))
    assert stored.count() == len(before) and stored.where("NOT startswith(load, 'compacted-') AND day <= 2").isEmpty()


def test_redelivery_after_compaction_is_left_out(spark, lake):
    land_in_loads(spark, SMALL, lake)
    before = landed(lake)
    compact_day(lake)
    land_in_loads(spark, SMALL, lake)
    assert landed(lake) == before


def test_new_checkpoint_keeps_older_rows(spark, lake):
    """A second query with a checkpoint of its own numbers its batches from 0 again."""
    readings = adapters.flow_readings(spark, SMALL)
    half = F.col("ingested_at") % 2 == 0
    for n, part in enumerate((half, ~half)):
        stream = replayed(spark, readings.where(part))
        app._start(stream, lake, f"land{n}", lambda batch, load: writers.land(batch, lake, tables.LANDING_FLOW, load), app.ONCE).awaitTermination()
    assert lake.read(tables.LANDING_FLOW).count() == readings.count()


def test_later_load_wins_and_repeated_load_keeps_its_place(spark, lake):
    rolled, dims = rollups.rollup(spark, SMALL).persist(), dimensions.seeded(spark)
    newer = rolled.withColumn("avg_speed_kmh", F.lit(1.0))
    writers.load_flow_facts(rolled, dims, lake, "old.3")
    writers.load_flow_facts(newer, dims, lake, "new.0")
    writers.load_flow_facts(rolled, dims, lake, "old.3")
    assert lake.read(tables.FACT_FLOW).where("avg_speed_kmh <> 1.0").isEmpty()
    merged = compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.FACT_FLOW]).first()
    assert merged.outcome == "compacted" and lake.read(tables.FACT_FLOW).count() == rolled.count()
    stored = spark.read.parquet(lake.path(tables.FACT_FLOW)).where("date_key = 20240101")
    assert stored.count() == merged.rows == rolled.where("window_start < TIMESTAMP '2024-01-02'").count()
    rolled.unpersist()


def test_days_beyond_the_calendar_reach_facts_and_calendar(spark, lake):
    dimension_store.bootstrap(lake)
    rolled = rollups.rollup(spark, SMALL).withColumns({c: F.col(c) + F.expr("INTERVAL 5 YEARS") for c in ("window_start", "window_end")}).persist()
    for load in ("b0", "b0"):
        writers.load_flow_facts(rolled, dimensions.stored(spark, dimension_store.folder(lake)), lake, load)
    facts, days = lake.read(tables.FACT_FLOW), spark.read.parquet(f"{dimension_store.folder(lake)}/dim_date")
    assert facts.count() == rolled.count() and lake.read_if_exists("quarantine/fact_traffic_flow") is None
    assert facts.join(days, "date_key", "left_anti").isEmpty() and days.count() == days.select("date_key").distinct().count()
    rolled.unpersist()


def test_implausible_days_are_rejected_whole(spark, lake):
    rolled = rollups.rollup(spark, SMALL)
    shifted = rolled.withColumns({c: F.col(c) + F.expr("INTERVAL 900 YEARS") for c in ("window_start", "window_end")}).persist()
    both = rolled.unionByName(shifted).persist()
    writers.load_flow_facts(both, dimensions.seeded(spark), lake, "b0")
    facts, dead = lake.read(tables.FACT_FLOW), lake.read("quarantine/fact_traffic_flow")
    assert facts.count() == dead.count() == rolled.count() and {r.reason for r in dead.select("reason").collect()} == {"day outside the calendar"}
    known = F.schema_of_json(F.lit(dead.first().record))
    record = dead.select(F.from_json("record", known).alias("r")).select("r.*")
    assert {"avg_speed_kmh", "sample_count", "location_name"} <= set(record.columns)
    assert record.agg(F.sum("sample_count")).first()[0] == rolled.agg(F.sum("sample_count")).first()[0]


def test_failed_compaction_exits_with_an_error(spark, lake, monkeypatch):
    from roadlake import __main__ as command

    land_in_loads(spark, SMALL, lake)
    monkeypatch.setattr(tables, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("x" * 900)))
    with pytest.raises(SystemExit) as ended:
        command.main(["compact", "--lake", lake.root, "--today", "2024-01-02"])
    assert ended.value.code == 1


def test_compaction_keeps_rows_and_reduces_files(spark, lake):
    land_in_loads(spark, SMALL, lake, loads=6)
    table = lake.read(tables.LANDING_FLOW).drop(tables.LOAD)
    before, first_day = table.toPandas(), table.where("day = 1")
    n_files, n_rows = files(first_day), first_day.count()
    (row,) = compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.LANDING_FLOW], files=2).collect()
    assert (row.outcome, row.rows) == ("compacted", n_rows)
    after = lake.read(tables.LANDING_FLOW).drop(tables.LOAD)
    assert files(after.where("day = 1")) <= 2 < n_files
    key = ["location_name", "ingested_at"]
    assert (
        after.select(*before.columns).toPandas().sort_values(key).reset_index(drop=True)
        .equals(before.sort_values(key).reset_index(drop=True))
    )


def test_compaction_takes_silver_tables_and_reports_missing_ones(spark, lake):
    writers.write_silver_flow(rollups.rollup(spark, SMALL), lake, "b0")
    outcome = {r.table_name: r.outcome for r in compaction.compact_previous_day(lake, date(2024, 1, 2)).collect()}
    assert outcome.pop("silver/flow") == "compacted" and set(outcome.values()) == {"missing"}
    (load,) = lake.read(tables.SILVER_FLOW).where("day = 1").select("load").distinct().toPandas()["load"]
    assert load.startswith(tables.COMPACTED)


def test_compaction_sizes_files_itself(spark, lake):
    land_in_loads(spark, SMALL, lake)
    (row,) = compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.LANDING_FLOW], files=None).collect()
    assert row.outcome == "compacted" and files(lake.read(tables.LANDING_FLOW).where("day = 1")) == 1


def test_late_load_after_compaction_joins_the_next_one(spark, lake):
    land_in_loads(spark, SMALL, lake)
    run = lambda: compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.LANDING_FLOW]).first()
    first = run()
    late = adapters.flow_readings(spark, SMALL).orderBy("ingested_at").limit(10)
    writers.land(late, lake, tables.LANDING_FLOW, "late")
    assert run().rows == first.rows + 10


def test_routing_loses_nothing(spark, lake):
    messages = adapters.checked_messages(spark, SMALL)
    checked = contract.check_records(messages, F.col("body"), contracts.FLOW_SCHEMA, contracts.FLOW_REQUIRED)
    writers.route(checked, contracts.FLOW_SCHEMA, lake, tables.LANDING_FLOW, "b0")
    good, bad = lake.read(tables.LANDING_FLOW), lake.read("quarantine/flow")
    assert good.count() + bad.count() == messages.count()
    assert bad.where("failed_at IS NULL OR reason IS NULL OR record IS NULL").isEmpty()


def test_zero_defaults_do_not_reject(spark):
    text = '{"ingested_at":1,"bbox_name":"a","category":"Jam","icon_category_id":6,"magnitude":1}'
    frame = spark.createDataFrame([(text,), ('{"bbox_name":"a"}',)], "body string")
    checked = contract.check_records(
        frame, F.col("body"), contracts.INCIDENT_SCHEMA, contracts.INCIDENT_REQUIRED, contracts.INCIDENT_ZERO_DEFAULTS
    )
    (row,) = contract.accepted(checked, contracts.INCIDENT_SCHEMA).collect()
    assert (row.delay_seconds, row.length_meters, row.from_location) == (0, 0, None)
    assert contract.rejected(checked).first().reason == "missing ingested_at, category, icon_category_id, magnitude"


# --- streams --------------------------------------------------------------------


def test_routed_stream_matches_batch(spark, lake):
    messages = adapters.checked_messages(spark, SMALL).withColumn("ingested_at", F.col("event_id"))
    stream = replayed(spark, messages, files_per_trigger=1)
    checked = contract.check_records(stream, F.col("body"), contracts.FLOW_SCHEMA, contracts.FLOW_REQUIRED)
    app.route_stream(checked, lake, tables.LANDING_FLOW, contracts.FLOW_SCHEMA, app.ONCE).awaitTermination()
    good, bad = lake.read(tables.LANDING_FLOW), lake.read("quarantine/flow")
    assert good.count() + bad.count() == messages.count()
    assert bad.count() == messages.where("event_id % 50 < 3").count()


def test_rows_per_batch_are_in_the_progress(spark, lake):
    readings = adapters.flow_readings(spark, SMALL)
    folder = fresh_folder(spark, "replay")
    readings.repartition(3).write.parquet(folder)
    query = app.land_stream(replay_stream(spark, folder, readings.schema, 1), lake, tables.LANDING_FLOW, app.ONCE)
    query.awaitTermination()
    counts = [p.observedMetrics["landing_flow"]["rows"] for p in query.recentProgress if p.observedMetrics]
    assert len(counts) > 1 and sum(counts) == readings.count()


def test_redelivered_batch_loads_once(spark, lake):
    """The batch before a crash is delivered again with its id."""
    rolled = rollups.rollup(spark, SMALL)
    dims = dimensions.seeded(spark)
    for _ in range(2):
        writers.write_silver_flow(rolled, lake, "b7")
        writers.load_flow_facts(rolled, dims, lake, "stream-b7")
    assert lake.read(tables.SILVER_FLOW).count() == lake.read(tables.FACT_FLOW).count() == rolled.count()


def test_stream_state_in_rocksdb(spark, lake):
    """The state store meant for large deployments gives the same windows."""
    from roadlake.session import STREAMING_CONF

    for key, value in STREAMING_CONF.items():
        spark.conf.set(key, value)
    try:
        readings = adapters.flow_readings(spark, SMALL)
        app.load_flow_stream(replayed(spark, readings), lake, None, app.ONCE).awaitTermination()
    finally:
        for key in STREAMING_CONF:
            spark.conf.unset(key)
    enriched = flow.enrich_readings(readings)
    end = enriched.agg(F.max("event_time")).first()[0]
    batch = flow.roll_up_readings(enriched).where(F.col("window_end") <= F.lit(end) - F.expr("INTERVAL 2 MINUTES"))
    found = lake.read(tables.SILVER_FLOW)
    columns = ["location_name", "window_start", "sample_count", "frc_code", "max_speed_kmh"]
    assert found.count() == batch.count()
    assert found.select(*columns).exceptAll(batch.select(*columns)).isEmpty()


def test_a_query_that_dies_ends_the_application(spark, lake):
    def fail(batch, load):
        raise ValueError("broken sink")

    readings = adapters.flow_readings(spark, SMALL)
    spark.streams.resetTerminated()
    running = app.App(lake)
    running.queries = [
        app.land_stream(replayed(spark, readings), lake, tables.LANDING_FLOW),
        app._start(replayed(spark, readings), lake, "broken", fail, app.EVERY_MINUTE),
    ]
    with pytest.raises(StreamingQueryException, match="broken sink"):
        running.await_any()
    assert not any(query.isActive for query in running.queries)
    spark.streams.resetTerminated()


def test_app_without_dimensions_loads_no_facts(spark, lake):
    running = app.start(
        lake, replayed(spark, adapters.flow_readings(spark, SMALL)),
        replayed(spark, adapters.incident_polls(spark, SMALL)), None, app.ONCE,
    )
    running.await_all()
    assert lake.read_if_exists(tables.FACT_FLOW) is None
    assert lake.read(tables.LANDING_INCIDENTS).count() == adapters.incident_polls(spark, SMALL).count()


def test_app_from_messages(spark, lake):
    """Enveloped messages of both feeds to landing, quarantine, silver and facts, with stored dimensions."""
    flow_messages = adapters.wire_messages(spark, SMALL)
    polls = adapters.incident_polls(spark, SMALL)
    incident_messages = polls.select(
        F.col("bbox_name").alias("key"),
        F.concat(F.unhex(F.lit("0000000001")), F.encode(adapters.record_json(*polls.columns), "UTF-8")).alias("value"),
        F.timestamp_millis("ingested_at").alias("timestamp"),
    )
    folder = dimension_store.folder(lake)
    for _ in range(2):
        dimension_store.bootstrap(lake)

    def stream(rows):
        return replayed(spark, rows.withColumn("ingested_at", F.col("timestamp")))

    running = app.start_from_messages(
        lake, stream(flow_messages), stream(incident_messages), lambda: dimensions.stored(spark, folder), app.ONCE
    )
    running.await_all()
    foreign = flow_messages.where("hex(substring(value, 1, 1)) = '01'").count()
    assert lake.read("quarantine/flow").count() == foreign > 0
    assert lake.read(tables.LANDING_FLOW).count() == flow_messages.count() - foreign
    assert lake.read(tables.LANDING_INCIDENTS).count() == polls.count()
    silver, facts = lake.read(tables.SILVER_FLOW), lake.read(tables.FACT_FLOW)
    assert silver.count() == facts.count() > 0
    assert lake.read(tables.FACT_INCIDENTS).count() == lake.read(tables.SILVER_INCIDENTS).count()
    assert lake.read("quarantine/flow").where("record IS NULL").isEmpty()
    assert facts.where("location_sk IS NULL AND location_name <> 'unlisted_point'").isEmpty()


def test_bootstrap_keeps_stored_rows(spark, lake):
    folder = dimension_store.folder(lake)
    dimension_store.bootstrap(lake)
    assert {t: spark.read.parquet(f"{folder}/{t}").count() for t in dimensions.TABLES} == {
        "dim_date": 1096, "dim_time": 96, "dim_location": 23, "dim_incident_category": 9,
    }
    kept = spark.read.parquet(f"{folder}/dim_incident_category").where("category_key <> 'jam'").withColumn(
        "category_label_en", F.lit("edited")
    ).toPandas()
    schema = dimensions.category_dimension(spark).schema
    spark.createDataFrame(kept, schema).write.mode("overwrite").parquet(f"{folder}/dim_incident_category")
    dimension_store.bootstrap(lake)
    labels = dict(spark.read.parquet(f"{folder}/dim_incident_category").select("category_key", "category_label_en").collect())
    assert len(labels) == 9 and labels.pop("jam") == "Traffic Jam" and set(labels.values()) == {"edited"}


def test_dead_letters_by_source(spark):
    letters = contract.rejected(contract.check_records(
        spark.createDataFrame([("{",)], "body string"), F.col("body"), contracts.FLOW_SCHEMA, contracts.FLOW_REQUIRED
    ))
    row = contract.by_source(letters, "flow").first()
    assert (row.source, row.error, row.payload) == ("flow", "malformed record", "{")


def test_bytes_that_are_no_text_are_quarantined(spark, lake):
    """Invalid UTF-8 in a payload neither stops the stream nor is lost."""
    bad = bytes([0, 0, 0, 0, 7, 0xC3, 0x28, 0xFF])
    messages = spark.createDataFrame([("k", bad, 1), ("k", b"\x01abc", 2)], "key string, value binary, n long")
    checked = app.FLOW.check(messages.withColumn("timestamp", F.timestamp_seconds("n")))
    writers.route(checked, app.FLOW.schema, lake, tables.LANDING_FLOW, "b0")
    dead = lake.read("quarantine/flow")
    assert {bytes(r.raw) for r in dead.select(F.unbase64("record").alias("raw")).collect()} == {bad, b"\x01abc"}
    assert {r.reason for r in dead.collect()} == {"malformed record"}


def test_missing_broker_package_is_named(spark):
    from roadlake.sources.streams import topic_stream

    with pytest.raises(RuntimeError, match="connector package"):
        topic_stream(spark, "broker:9092", "topic")


def test_command_line(spark, lake, capsys):
    from roadlake.__main__ import arguments

    args = arguments(["compact", "--lake", "x", "--today", "2024-01-02", "--files", "0"])
    assert (args.today, args.files) == (date(2024, 1, 2), 0)
    assert arguments(["stream", "--lake", "x", "--servers", "b:1"]).max_records == 0


# --- versions, files and overlaps -------------------------------------------------


def test_first_fit_bounds_files():
    from roadlake.sinks.packing import first_fit

    counts = [7, 250, 1, 1, 1, 40, 99, 3] * 5
    placed = first_fit(counts, 4, 100)
    held = {}
    for n, (first, pieces) in zip(counts, placed, strict=True):
        for task in range(first, first + pieces):
            held[task] = held.get(task, 0) + n / pieces
    assert max(held.values()) <= 100 and all(p == -(-n // 100) for n, (_, p) in zip(counts, placed, strict=True))
    assert len(held) == max(held) + 1 < len(counts)


def test_stream_writes_one_file_per_folder(spark, lake):
    """Adaptive execution, and with it the rebalance hint, is off in a micro-batch."""
    readings = adapters.flow_readings(spark, SMALL)
    app.load_flow_stream(replayed(spark, readings), lake, dimensions.seeded(spark), app.ONCE).awaitTermination()
    for table, by in ((tables.SILVER_FLOW, ["year", "month", "day", "city", "load"]), (tables.FACT_FLOW, ["date_key", "load"])):
        per_folder = lake.read(table).withColumn("file", F.input_file_name()).groupBy(*by).agg(F.countDistinct("file").alias("files"))
        assert per_folder.agg(F.max("files")).first()[0] == 1


def test_hot_partition_is_spread_over_files(spark, lake, monkeypatch):
    from roadlake.sinks import packing

    rows = spark.range(4000).selectExpr("id", "CAST(2024 AS INT) year", "CAST(1 AS INT) month", "CAST(IF(id < 3900, 1, id % 30 + 2) AS INT) day").persist()
    monkeypatch.setattr(packing, "rows_per_file", lambda *a: 1000)
    tables.write_load(lake, tables.LANDING_FLOW, rows, "b0", gather=True)
    stored = lake.read(tables.LANDING_FLOW)
    assert stored.count() == 4000 and files(stored.where("day = 1")) == 4
    others = stored.where("day > 1").withColumn("file", F.input_file_name()).groupBy("day").agg(F.countDistinct("file").alias("n"))
    assert all(r.n == 1 for r in others.collect())
    rows.unpersist()


def test_landed_batch_of_many_days_has_one_file_a_day(spark, lake):
    """A batch that is not persisted, from eight tasks that each hold all days; of few days no row moves."""
    rows = spark.range(0, 8000, 1, 8).selectExpr("id", "(1704067200 + id % 100 * 86400) * 1000 AS ingested_at")
    for load, days in (("many", 100), ("few", 3)):
        writers.land(rows.where(f"id % 100 < {days}"), lake, tables.LANDING_INCIDENTS, load)
        stored = lake.read(tables.LANDING_INCIDENTS).where(F.col("load") == load)
        assert stored.count() == 80 * days and stored.select("id").distinct().count() == 80 * days
        assert files(stored) == (100 if load == "many" else 8 * 3)


def test_size_of_a_row_that_is_not_persisted_is_that_of_its_columns(spark):
    from roadlake.sinks import packing

    rows = spark.range(1000).crossJoin(spark.range(1000).withColumnRenamed("id", "other"))
    assert packing.rows_per_file(rows, 1_000_000, 1600, persisted=False) == 100


def test_reader_during_a_rewrite_sees_one_of_both(spark, lake, monkeypatch):
    """Files of a new attempt, and those of the old one, are there: only a published version counts."""
    from roadlake.sinks import snapshots

    readings = adapters.flow_readings(spark, SMALL)
    writers.land(readings, lake, tables.LANDING_FLOW, "b0")
    before, seen, real = landed(lake), [], snapshots.commit

    def look_first(*args):
        seen.append(landed(lake))
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", look_first)
    writers.land(readings.limit(7), lake, tables.LANDING_FLOW, "b0")
    assert seen == [before] and len(landed(lake)) == 7


def test_late_rewrite_of_a_replaced_load_is_left_out(spark, lake, monkeypatch):
    """It began before compaction and ends after the replaced files are gone."""
    from roadlake.sinks import snapshots

    land_in_loads(spark, SMALL, lake)
    before, real = landed(lake), snapshots.commit
    first = adapters.flow_readings(spark, SMALL).where("(ingested_at div 3600000) % 4 = 0")

    def compact_first(*args):
        monkeypatch.setattr(snapshots, "commit", real)
        assert compact_day(lake).outcome == "compacted"
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", compact_first)
    writers.land(first, lake, tables.LANDING_FLOW, "b0")
    assert landed(lake) == before
    compact_day(lake)
    assert landed(lake) == before and spark.read.parquet(lake.path(tables.LANDING_FLOW)).where("day = 1 AND load = 'b0'").isEmpty()


def test_two_writers_at_once_both_count(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    readings = adapters.flow_readings(spark, SMALL)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: writers.land(readings, lake, tables.LANDING_FLOW, f"s.{n}"), range(4)))
    assert lake.read(tables.LANDING_FLOW).count() == 4 * readings.count()
    compact_day(lake)
    replaced = lake.snapshot(tables.LANDING_FLOW).replaced["year=2024/month=1/day=1"]
    assert replaced == {"s": [[0, 3]]}  # a day of batches is one range


def test_two_writers_add_a_day_once(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    dimension_store.bootstrap(lake)
    days = spark.sql("SELECT explode(sequence(DATE '2031-01-01', DATE '2031-01-20')) AS full_date")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda part: dimension_store.add_days(lake, part), (days, days.where("day(full_date) > 5"))))
    stored = spark.read.parquet(f"{dimension_store.folder(lake)}/dim_date")
    assert stored.count() == 1096 + 20 == stored.select("date_key").distinct().count()


def test_added_days_get_their_holidays(spark, lake):
    folder = f"{dimension_store.folder(lake)}/dim_date"
    days = lambda first, last: spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS full_date")
    dimensions.calendar_rows(spark, days("2024-04-01", "2024-04-20")).write.parquet(folder)
    dimension_store.add_days(lake, days("2024-04-15", "2024-05-02"))
    holidays = spark.read.parquet(folder).where("is_public_holiday").orderBy("full_date").collect()
    assert [(str(r.full_date), r.holiday_name) for r in holidays] == [
        ("2024-04-25", "Sinai Liberation Day"), ("2024-05-01", "Labour Day"),
    ]
    assert spark.read.parquet(folder).count() == 32


def test_only_overlapping_days_are_merged(spark, lake):
    """Loads of other hours of a day have no key in common; a reload has."""
    rolled, dims = rollups.rollup(spark, SMALL).persist(), dimensions.seeded(spark)
    morning = F.col("window_start") < F.expr("TIMESTAMP '2024-01-01 12:00:00'")
    for n, part in enumerate((morning, ~morning)):
        writers.load_flow_facts(rolled.where(part), dims, lake, f"s.{n}")
    assert tables.overlapping_partitions(lake.snapshot(tables.FACT_FLOW)) == []
    facts = lake.read(tables.FACT_FLOW)
    assert "Aggregate" not in facts._jdf.queryExecution().executedPlan().toString() and facts.count() == rolled.count()
    second = rolled.where("window_start >= TIMESTAMP '2024-01-02'").withColumn("avg_speed_kmh", F.lit(-1.0))
    writers.load_flow_facts(second, dims, lake, "s.2")
    assert tables.overlapping_partitions(lake.snapshot(tables.FACT_FLOW)) == ["date_key=20240102"]
    facts = lake.read(tables.FACT_FLOW)
    assert facts.count() == rolled.count() and facts.where("avg_speed_kmh = -1.0 AND date_key < 20240102").isEmpty()
    assert facts.where("avg_speed_kmh <> -1.0 AND date_key = 20240102").isEmpty()
    rolled.unpersist()


def test_latest_windows_after_reloads(spark, lake):
    """Reloaded rows do not count towards the newest ones."""
    from roadlake.plans import marts

    rolled, dims = rollups.rollup(spark, "/root/testdata/sf0.01").persist(), dimensions.seeded(spark)
    last_windows = rolled.orderBy(F.desc("window_start")).limit(45).persist()
    writers.load_flow_facts(rolled, dims, lake, "all")
    for n in range(3):
        writers.load_flow_facts(last_windows, dims, lake, f"again{n}")
    newest = marts.latest_windows(lake.read(tables.FACT_FLOW), tables.certain_since(lake.snapshot(tables.FACT_FLOW), 100))
    expected = [r.window_start for r in rolled.orderBy(F.desc("window_start")).limit(100).collect()]
    assert [r.window_start_utc for r in newest.collect()] == expected
    days = [int(p.partition("=")[2]) for p in lake.snapshot(tables.FACT_FLOW).loads[0].parts]
    assert tables.certain_since(lake.snapshot(tables.FACT_FLOW), rolled.count() + 1) == 0 < min(days)
    rolled.unpersist()


def test_dead_letters_of_a_retry_after_midnight_count_once(spark, lake):
    letters = spark.createDataFrame([("bad", "x"), ("bad", "y")], "reason string, record string")
    at = lambda day: letters.withColumn("failed_at", F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp"))
    writers.quarantine(at(1), lake, "flow", "s.1")
    writers.quarantine(at(2), lake, "flow", "s.1")
    assert lake.read("quarantine/flow").count() == 2
    assert compaction.compact_previous_day(lake, date(2024, 1, 3), ["quarantine/flow"]).first().outcome == "compacted"
    writers.quarantine(at(4), lake, "flow", "s.1")
    assert lake.read("quarantine/flow").count() == 2


def test_raw_responses_are_landed_or_quarantined_by_the_application(spark, lake):
    flow_bodies = adapters.broken_flow_json(spark, SMALL).drop("kind")
    incident_bodies = adapters.raw_incident_json(spark, SMALL, F.col("o_orderkey") % 40 == 7)
    for query in app.response_streams(replayed(spark, flow_bodies), replayed(spark, incident_bodies), lake, app.ONCE):
        query.awaitTermination()
    n, orders = flow_bodies.count(), spark.read.parquet(f"{SMALL}/orders.parquet")
    assert lake.read(tables.LANDING_FLOW).count() + lake.read("quarantine/flow").count() == n
    assert lake.read("quarantine/flow").count() > 0
    bad = orders.where("o_orderkey % 40 = 7").count()
    dead = lake.read("quarantine/incidents")
    assert dead.count() == bad > 0 and dead.where("NOT contains(record, '\"length\":\"x')").isEmpty()
    assert lake.read(tables.LANDING_INCIDENTS).count() == orders.count() - bad


def observations(spark, *rows):
    return spark.createDataFrame(list(rows), "location_key string, frc string, effective_date string")


def versions(lake, key):
    rows = dimensions.stored(lake.spark, dimension_store.folder(lake)).location.where(F.col("location_key") == key)
    columns = ["version_number", "frc", "valid_from", "valid_to", "is_current"]
    return [(n, frc, str(a), str(b) if b else None, c) for n, frc, a, b, c in rows.orderBy("version_number").select(*columns).collect()]


def test_stored_locations_roll(spark, lake):
    """Facts loaded after a roll carry the new version's key, those before keep theirs."""
    dimension_store.bootstrap(lake)
    folder, rolled = dimension_store.folder(lake), rollups.rollup(spark, SMALL).persist()
    place = rolled.where("location_name <> 'unlisted_point'").first().location_name
    old = dimensions.stored(spark, folder).location.where(F.col("location_key") == place).first()
    writers.load_flow_facts(rolled.where("window_start < TIMESTAMP '2024-01-02'"), dimensions.stored(spark, folder), lake, "s.0")
    for _ in range(2):  # a repeated roll changes nothing
        dimension_store.roll_locations(lake, observations(
            spark, (place, "FRC6", "2024-01-02"), ("nowhere", "FRC1", "2024-01-02"), ("giza_pyramids", None, "2024-01-02"),
        ))
    assert versions(lake, place) == [
        (1, old.frc, "2024-01-01", "2024-01-02", False), (2, "FRC6", "2024-01-02", None, True),
    ]
    dimension_store.bootstrap(lake)
    stored = dimensions.stored(spark, folder).location
    assert stored.count() == 24 and stored.where("is_current").count() == 23
    new = stored.where("version_number = 2").first()
    assert (new.road_type, new.frc_label) == ("local", "Private / Unpaved Road")
    writers.load_flow_facts(rolled.where("window_start >= TIMESTAMP '2024-01-02'"), dimensions.stored(spark, folder), lake, "s.1")
    facts = lake.read(tables.FACT_FLOW).where(F.col("location_name") == place)
    assert {(r[0], r[1]) for r in facts.select(F.col("date_key") < 20240102, "location_sk").collect()} <= {
        (True, old.location_sk), (False, new.location_sk),
    }
    assert lake.read(tables.FACT_FLOW).count() == rolled.count()
    rolled.unpersist()


def test_a_roll_happens_whole_or_not_at_all(spark, lake, monkeypatch):
    dimension_store.bootstrap(lake)
    asked = observations(spark, ("tahrir_square", "FRC0", "2024-05-01"), ("giza_square", "FRC4", "2024-05-01"))

    def breaks(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(dimension_store.snapshots, "publish_file", breaks)
        with pytest.raises(OSError):
            dimension_store.roll_locations(lake, asked)
    assert [v[0] for v in versions(lake, "tahrir_square")] == [1] and versions(lake, "giza_square")[0][4]
    dimension_store.roll_locations(lake, asked)
    assert [v[0] for v in versions(lake, "tahrir_square")] == [v[0] for v in versions(lake, "giza_square")] == [1, 2]


def test_two_rolls_at_a_time_leave_one_current_version(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    from roadlake.operators import history

    dimension_store.bootstrap(lake)
    asked = [observations(spark, ("tahrir_square", frc, day)) for frc, day in (("FRC0", "2024-05-01"), ("FRC5", "2024-06-01"))]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda seen: dimension_store.roll_locations(lake, seen), asked))
    found = versions(lake, "tahrir_square")
    # The later one always counts; the earlier one does if it came first.
    assert found[-1][1:] == ("FRC5", "2024-06-01", None, True) and [v[4] for v in found].count(True) == 1
    assert history.overlapping_versions(dimensions.stored(spark, dimension_store.folder(lake)).location).isEmpty()


def test_unclear_rolls_are_refused(spark, lake):
    seen = observations(spark, ("tahrir_square", "FRC0", "2024-05-01"), ("tahrir_square", "FRC4", "2024-06-01"))
    with pytest.raises(ValueError, match="no locations"):
        dimension_store.roll_locations(lake, seen.limit(1))
    dimension_store.bootstrap(lake)
    with pytest.raises(ValueError, match="several observations of tahrir_square"):
        dimension_store.roll_locations(lake, seen)
    with pytest.raises(ValueError, match="none of road_type, frc, frc_label"):
        dimension_store.roll_locations(lake, seen.drop("frc"))
