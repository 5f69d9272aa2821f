"""Rollups against plain Python, hot keys, NULLs and invariants."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadlake.operators import flow, incidents
from roadlake.sources import adapters, contracts

from test_expressions import poll, polls, reading


def frame_of(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in contracts.FLOW_SCHEMA.names) for r in rows], contracts.FLOW_SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 1800), st.sampled_from(["tahrir_square", "giza_square"]), st.integers(0, 80),
            st.sampled_from([0, 50]), st.sampled_from(["FRC0", "FRC1", "FRC2"]), st.booleans(),
        ),
        min_size=1, max_size=25,
    )
)
def test_rollup_equals_brute_force(spark, sample):
    rows = [
        reading(ingested_at=1704067200000 + s * 1000, location_name=place, current_speed_kmh=cs, free_flow_speed_kmh=ff,
                frc=frc, road_closed=closed)
        for s, place, cs, ff, frc, closed in sample
    ]
    groups = defaultdict(list)
    for s, place, cs, ff, frc, closed in sample:
        groups[(s // 900, place)].append((s, cs, ff, frc, closed))
    rolled = flow.roll_up_readings(flow.enrich_readings(frame_of(spark, rows))).collect()
    assert len(rolled) == len(groups)
    for row in rolled:
        members = groups[((int(row.window_start.timestamp()) - 1704067200) // 900, row.location_name)]
        assert row.sample_count == len(members)
        assert abs(row.avg_speed_kmh - sum(m[1] for m in members) / len(members)) < 1e-9
        assert row.min_speed_kmh == min(m[1] for m in members) and row.max_speed_kmh == max(m[1] for m in members)
        drops = [round((50 - m[1]) / 50 * 100, 2) for m in members if m[2]]
        assert (row.avg_speed_drop_pct is None) == (not drops)
        if drops:
            assert abs(row.avg_speed_drop_pct - sum(drops) / len(drops)) < 1e-6
        assert row.frc_code == min((m[0], m[3]) for m in members)[1]
        assert row.road_closed_flag == min((m[0], m[4]) for m in members)[1]


def test_rollup_does_not_depend_on_order_or_partitions(spark, sf_dir):
    readings = adapters.flow_readings(spark, sf_dir)
    one = flow.roll_up_readings(flow.enrich_readings(readings.coalesce(1)))
    many = flow.roll_up_readings(flow.enrich_readings(readings.orderBy(F.desc("ingested_at")).repartition(13)))
    columns = ["location_name", "window_start", "frc_code", "congestion_level", "confidence_band", "lat", "sample_count"]
    assert one.select(*columns).exceptAll(many.select(*columns)).isEmpty()


def test_invariants(spark, sf_dir):
    readings = adapters.flow_readings(spark, sf_dir)
    rolled = flow.roll_up_readings(flow.enrich_readings(readings)).persist()
    assert rolled.agg(F.sum("sample_count")).first()[0] == readings.count()
    assert rolled.where("avg_speed_kmh < min_speed_kmh OR avg_speed_kmh > max_speed_kmh").isEmpty()
    assert rolled.groupBy("window_start", "location_name").count().where("count > 1").isEmpty()
    rolled.unpersist()


def test_hot_location_is_reduced_before_the_shuffle(spark):
    """A third of all readings in one window of one place: few rows are shuffled for it."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.lit(1704067200000).alias("ingested_at"),
        F.when(F.col("id") % 3 == 0, F.lit("tahrir_square")).otherwise(F.concat(F.lit("p"), F.col("id") % 5000)).alias("location_name"),
        F.lit(30.0).alias("query_lat"), F.lit(31.0).alias("query_lon"),
        F.lit(None).cast("double").alias("segment_lat"), F.lit(None).cast("double").alias("segment_lon"),
        F.lit("FRC1").alias("frc"), (F.col("id") % 100).cast("int").alias("current_speed_kmh"),
        F.lit(100).alias("free_flow_speed_kmh"), F.lit(60).alias("current_travel_time"),
        F.lit(60).alias("free_flow_travel_time"), F.lit(0.9).cast("float").alias("confidence"),
        F.lit(False).alias("road_closed"), F.lit(0.5).cast("float").alias("congestion_ratio"),
    )
    rolled = flow.roll_up_readings(flow.enrich_readings(rows))
    hot = rolled.where("location_name = 'tahrir_square'").collect()
    assert [r.sample_count for r in hot] == [20_000]
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and plan.count("Exchange") == 1


def test_polls_collapse_and_fill_nulls(spark):
    rows = [
        poll(ingested_at=1704067200000, lat=None, lon=None, road_numbers=None, magnitude=1),
        poll(ingested_at=1704067260000, lat=30.5, lon=31.5, road_numbers="R1", magnitude=3),
        poll(ingested_at=1704067200000 + 900_000, magnitude=4),
    ]
    out = sorted(incidents.collapse_polls(polls(spark, *rows)).collect(), key=lambda r: r.event_time)
    assert len(out) == 2
    assert (out[0].magnitude, out[0].magnitude_label) == (1, "Minor")
    assert (out[0].lat, out[0].road_numbers, out[0].has_known_location) == (30.5, "R1", False)


def test_unknown_identity_parts_group_together(spark):
    rows = [poll(from_location=None, to_location=None, start_time="n/a", delay_seconds=n) for n in (30, 10, 20)]
    (row,) = incidents.collapse_polls(polls(spark, *rows)).collect()
    assert row.delay_seconds == 10 and row.start_time_parsed is None


def test_areas_keep_the_same_incident_apart(spark):
    rows = [poll(bbox_name=b) for b in ("cairo_east", "cairo_ring_road")]
    assert incidents.collapse_polls(polls(spark, *rows)).count() == 2


def test_enriched_reports_collapse_like_raw_ones(spark, sf_dir):
    raw = adapters.incident_polls(spark, sf_dir)
    a = incidents.collapse_polls(raw)
    b = incidents.collapse_polls(incidents.enrich_incidents(raw))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 1800),
            st.one_of(st.none(), st.sampled_from([-(2**31), -1, 0, 1, 2**31 - 1])),
            st.one_of(st.none(), st.sampled_from(["", "R1", "R2"])),
            st.one_of(st.none(), st.sampled_from([-1.5, 0.25, float("inf")])),
        ),
        min_size=1, max_size=25,
    )
)
def test_collapse_equals_brute_force(spark, sample):
    rows = [
        poll(ingested_at=1704067200000 + s * 1000, delay_seconds=delay, road_numbers=roads, lat=lat)
        for s, delay, roads, lat in sample
    ]
    windows = defaultdict(list)
    for row in sample:
        windows[row[0] // 900].append(row)
    collapsed = incidents.collapse_polls(polls(spark, *rows)).collect()
    assert len(collapsed) == len(windows)
    for row in collapsed:
        members = windows[(int(row.event_time.timestamp()) - 1704067200) // 900]
        for field, position in (("delay_seconds", 1), ("road_numbers", 2), ("lat", 3)):
            known = [(m[0], m[position]) for m in members if m[position] is not None]
            assert row[field] == (min(known)[1] if known else None)


def test_polls_are_hashed_not_sorted(spark):
    """A third of all polls are of one incident. Up to the second shuffle nothing is sorted, and few rows reach it."""
    one = polls(spark, poll())
    place = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500))
    rows = spark.range(0, 30_000, 1, 8).join(F.broadcast(one)).withColumn("from_location", place).drop("id")
    collapsed = incidents.collapse_polls(rows)
    assert collapsed.count() == 501
    plan = collapsed._jdf.queryExecution().executedPlan().toString()
    steps = re.findall(r"(SortAggregate|HashAggregate|Sort \[|Exchange hashpartitioning)", plan)[::-1]
    assert steps[:3] == ["HashAggregate", "Exchange hashpartitioning", "HashAggregate"]
    assert steps.count("Exchange hashpartitioning") == 2


def test_streamed_collapse_keeps_one_state(spark, tmp_path):
    """One stateful step, with the rows the two steps of a batch give."""
    rows = [
        poll(ingested_at=1704067200000 + n * 60_000, road_numbers=roads, lat=lat, delay_seconds=delay)
        for n, (roads, lat, delay) in enumerate([(None, 1.0, None), ("R2", None, 5), ("R1", 2.0, 3), (None, None, None)] * 10)
    ]
    source = polls(spark, *rows)
    source.coalesce(1).write.parquet(str(tmp_path / "polls"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "polls"))
    out, found = [], ["city", "road_numbers", "lat", "lon", "delay_seconds", "delay_minutes", "is_active", "event_time"]
    run = incidents.collapse_polls(stream).writeStream.foreachBatch(lambda batch, n: out.extend(batch.select(*found).collect()))
    query = run.option("checkpointLocation", str(tmp_path / "kept")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert all(len(p["stateOperators"]) == 1 for p in query.recentProgress)
    whole = incidents.collapse_polls(source).select(*found).collect()
    last = max(r.event_time for r in whole)
    assert sorted(out, key=str) == sorted((r for r in whole if r.event_time < last), key=str) and len(out) == 2


def test_replayed_stream_closes_windows_as_it_goes_on(spark, tmp_path, monkeypatch):
    """Files are taken in time order, a few a batch: no row is late, and state holds open windows only."""
    from roadlake.catalog import streams
    from roadlake.session import stream_settings

    monkeypatch.setattr(streams, "FILE_ROWS", 24, raising=False)
    monkeypatch.setattr(streams, "CORE_BYTES", 1, raising=False)
    minutes = [n * 7919 % 240 for n in range(240)]  # written in no order
    source = polls(spark, *[poll(ingested_at=1704067200000 + m * 60_000, from_location=f"P{m % 5}", delay_seconds=m) for m in minutes])
    out, found = [], ["from_location", "delay_seconds", "event_time"]
    stream = incidents.collapse_polls(streams.replayed(spark, source.repartition(8)))
    run = stream.writeStream.foreachBatch(lambda batch, n: out.extend(batch.select(*found).collect()))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        with stream_settings(spark):
            query = run.option("checkpointLocation", str(tmp_path / "kept")).trigger(availableNow=True).start()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "32"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    query.awaitTermination()
    state = [p["stateOperators"][0] for p in query.recentProgress]
    whole = incidents.collapse_polls(source).select(*found).collect()
    last = max(r.event_time for r in whole)
    assert sorted(out) == sorted(r for r in whole if r.event_time < last) and len(out) == 75
    assert len(state) > 5 and max(s["numRowsTotal"] for s in state) <= 35 and not any(s["numRowsDroppedByWatermark"] for s in state)
    assert all(s["numShufflePartitions"] == min(32, spark.sparkContext.defaultParallelism) for s in state)


def test_streamed_polls_are_sorted_by_a_number_first(spark, tmp_path):
    """A struct, as the window is, has no prefix that a sort could compare."""
    source = polls(spark, poll())
    source.write.parquet(str(tmp_path / "polls"))
    collapsed = incidents.collapse_polls(spark.readStream.schema(source.schema).parquet(str(tmp_path / "polls")))
    query = collapsed.writeStream.foreachBatch(lambda batch, n: batch.count())
    query = query.option("checkpointLocation", str(tmp_path / "kept")).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    first = re.findall(r"Sort \[(\w+)", plan)
    assert len(first) == 4 and not any(name.startswith("window") for name in first)


def test_application_over_several_batches_holds_all_rows(spark, tmp_path, monkeypatch):
    """Both feeds in several batches each: every row is landed once, every closed window is loaded once."""
    from roadlake.catalog import streams
    from roadlake.sinks import lake as tables
    from roadlake.sources import dimensions
    from roadlake.streaming import app

    monkeypatch.setattr(streams, "FILE_ROWS", 60, raising=False)
    monkeypatch.setattr(streams, "CORE_BYTES", 1, raising=False)
    at = [1704067200000 + n * 37 % 120 * 60_000 for n in range(120)]  # written in no order
    readings = frame_of(spark, [reading(ingested_at=t, location_name=place) for t in at for place in ("tahrir_square", "giza_square")])
    reports = polls(spark, *[poll(ingested_at=t, from_location=f"P{n % 3}", delay_seconds=n) for n, t in enumerate(at)])
    lake = tables.Lake(spark, str(tmp_path / "lake"))
    app.start(lake, streams.replayed(spark, readings), streams.replayed(spark, reports), dimensions.seeded(spark), app.ONCE).await_all()
    names = [tables.LANDING_FLOW, tables.LANDING_INCIDENTS, tables.SILVER_FLOW, tables.FACT_FLOW, tables.SILVER_INCIDENTS, tables.FACT_INCIDENTS]
    assert [lake.read(name).count() for name in names] == [240, 120, 14, 14, 21, 21]
    assert [len(lake.snapshot(name).loads) for name in names[:2]] == [4, 2]
    assert not any(tables.overlapping_partitions(lake.snapshot(name)) for name in names[3::2])
