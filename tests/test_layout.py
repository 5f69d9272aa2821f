"""Clustered fact files: reads within ranges list few files, prune inside them, and lose nothing."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from roadlake.catalog import rollups
from roadlake.functions import codes
from roadlake.session import fresh_folder
from roadlake.sinks import compaction, layout, writers
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import dimensions

SMALL = "/root/testdata/sf0.001"
KEY = 20240101


@pytest.fixture
def lake(spark):
    return Lake(spark, fresh_folder(spark, "layout"))


def compact(lake, table, files=None):
    (row,) = compaction.compact_previous_day(lake, date(2024, 1, 2), [table], files=files).collect()
    assert row.outcome == "compacted"


def one_day_of_incidents(spark):
    """All collapsed incidents, moved to one day."""
    rows = rollups.collapsed(spark, SMALL)
    moved = F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.unix_seconds("event_time") % 86400
    return rows.withColumn("event_time", F.timestamp_seconds(moved))


def box(area):
    _, _, lat0, lon0, lat1, lon1 = area
    return {"lat": (lat0, lat1), "lon": (lon0, lon1)}


def keys_of(frame, column):
    return sorted(r[0] for r in frame.select(column).collect())


def scanned_rows(frame):
    """Rows that the scan let through, before the filter."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def interleaved(lat, lon):
    top = (1 << layout.COORDINATE_BITS) - 1
    y = int((min(max(lat, -90.0), 90.0) + 90.0) / 180.0 * float(top))
    x = int((min(max(lon, -180.0), 180.0) + 180.0) / 360.0 * float(top))
    return sum((y >> b & 1) << (2 * b + 1) | (x >> b & 1) << (2 * b) for b in range(layout.COORDINATE_BITS))


def test_z_order_interleaves_the_bits(spark):
    places = [(30.05, 31.2), (30.0500001, 31.2), (-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (500.0, -700.0)]
    rows = spark.createDataFrame([*places, (None, 31.0)], "lat double, lon double")
    found = [r[0] for r in rows.select(layout.z_order(F.col("lat"), F.col("lon"))).collect()]
    assert found == [*(interleaved(*p) for p in places), None]


def test_area_read_skips_files(spark, lake):
    rows = one_day_of_incidents(spark).persist()
    dims = dimensions.seeded(spark)
    half = F.hour("event_time") < 12
    for n, part in enumerate((half, ~half)):
        writers.load_incident_facts(rows.where(part), dims, lake, f"s.{n}")
    before = lake.read(tables.FACT_INCIDENTS).persist()
    expected = {a[0]: keys_of(before.where(layout.within(box(a))), "incident_sk") for a in codes.AREAS}
    assert any(expected.values())
    compact(lake, tables.FACT_INCIDENTS, files=12)
    everything = lake.read(tables.FACT_INCIDENTS)
    files = len(everything.inputFiles())
    assert files >= 8 and keys_of(everything, "incident_sk") == keys_of(before, "incident_sk")
    for area in codes.AREAS:
        found = lake.read_within(tables.FACT_INCIDENTS, box(area))
        assert keys_of(found, "incident_sk") == expected[area[0]]
    alexandria = lake.read_within(tables.FACT_INCIDENTS, box(codes.AREAS[3]))
    assert 0 < len(alexandria.inputFiles()) <= files // 2
    nowhere = lake.read_within(tables.FACT_INCIDENTS, {"lat": (-60.0, -50.0), "lon": (0.0, 1.0)})
    assert nowhere.isEmpty() and nowhere.inputFiles() == [] and nowhere.columns == everything.columns
    before.unpersist()
    rows.unpersist()


def test_a_row_that_moved_out_of_the_range_does_not_come_back(spark, lake):
    """A later load replaces rows by others outside the ranges: files of both must be read."""
    rows, dims = one_day_of_incidents(spark).persist(), dimensions.seeded(spark)
    writers.load_incident_facts(rows, dims, lake, "s.0")
    compact(lake, tables.FACT_INCIDENTS, files=8)
    area = box(codes.AREAS[3])
    assert not lake.read_within(tables.FACT_INCIDENTS, area).isEmpty()
    away = rows.withColumn("lat", F.lit(10.0)).withColumn("lon", F.lit(10.0))
    writers.load_incident_facts(away, dims, lake, "s.1")
    assert lake.read_within(tables.FACT_INCIDENTS, area).isEmpty()
    compact(lake, tables.FACT_INCIDENTS, files=8)
    assert lake.read_within(tables.FACT_INCIDENTS, area).isEmpty()
    assert lake.read_within(tables.FACT_INCIDENTS, {"lat": (10.0, 10.0)}).count() == lake.read(tables.FACT_INCIDENTS).count()
    rows.unpersist()


def test_place_and_key_reads_skip_files_and_row_groups(spark, lake):
    rolled, dims = rollups.rollup(spark, "/root/testdata/sf0.01").persist(), dimensions.seeded(spark)
    hour = F.hour("window_start")
    for n in range(3):
        writers.load_flow_facts(rolled.where(hour % 3 == n), dims, lake, f"s.{n}")
    # Loads dealt out by hours overlap; the compacted day does not.
    first_day = lake.read(tables.FACT_FLOW).where(F.col("date_key") == KEY).persist()
    places = keys_of(first_day.select("location_name").distinct(), "location_name")
    compact(lake, tables.FACT_FLOW, files=6)
    day = lambda frame: frame.where(F.col("date_key") == KEY)
    files = len(day(lake.read(tables.FACT_FLOW)).inputFiles())
    for place in (places[0], places[len(places) // 2], places[-1]):
        found = day(lake.read_within(tables.FACT_FLOW, {"location_name": (place, place)}))
        assert keys_of(found, "flow_sk") == keys_of(first_day.where(F.col("location_name") == place), "flow_sk")
        assert len([f for f in found.inputFiles() if f"date_key={KEY}" in f]) < files
    wanted = first_day.orderBy("flow_sk").first().flow_sk
    one = day(lake.read(tables.FACT_FLOW)).where(F.col("flow_sk") == wanted)
    assert scanned_rows(one) < first_day.count() / 2 and keys_of(one, "flow_sk") == [wanted]
    first_day.unpersist()
    rolled.unpersist()


def test_a_place_with_most_rows_is_spread_over_files(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("incident"), F.when(F.col("id") % 3 > 0, 30.0).otherwise(F.col("id") / 1000.0).alias("lat"), F.lit(31.0).alias("lon")
    )
    dealt = layout.clustered(rows, layout.LAYOUTS[tables.FACT_INCIDENTS], 9, [], ["incident"])
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2500


def test_empty_positions_and_nan_stay_whole(spark, lake):
    rows = one_day_of_incidents(spark).persist()
    odd = rows.withColumn("lat", F.when(F.col("from_location").isNull(), F.lit(None)).when(F.col("to_location").isNull(), float("nan")).otherwise(F.col("lat")))
    writers.load_incident_facts(odd, dimensions.seeded(spark), lake, "s.0")
    before = lake.read(tables.FACT_INCIDENTS).persist()
    expected = keys_of(before.where(layout.within(box(codes.AREAS[0]))), "incident_sk")
    total = before.count()
    compact(lake, tables.FACT_INCIDENTS, files=6)
    assert lake.read(tables.FACT_INCIDENTS).count() == total
    assert keys_of(lake.read_within(tables.FACT_INCIDENTS, box(codes.AREAS[0])), "incident_sk") == expected
    before.unpersist()
    rows.unpersist()


def test_ranges_go_with_their_load(spark, lake):
    rolled, dims = rollups.rollup(spark, SMALL).persist(), dimensions.seeded(spark)
    writers.load_flow_facts(rolled, dims, lake, "s.0")
    compact(lake, tables.FACT_FLOW)
    (first,) = [x for x in lake.snapshot(tables.FACT_FLOW).loads if x.ranged]
    writers.load_flow_facts(rolled, dims, lake, "s.9")
    compact(lake, tables.FACT_FLOW)
    (second,) = [x for x in lake.snapshot(tables.FACT_FLOW).loads if x.ranged]
    kept = lake.spark.read.parquet(tables.ranges_folder(lake, tables.FACT_FLOW, second.attempt))
    assert kept.agg(F.sum("row_count")).first()[0] == second.parts[f"date_key={KEY}"][0]
    path = spark._jvm.org.apache.hadoop.fs.Path(tables.ranges_folder(lake, tables.FACT_FLOW, first.attempt))
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rolled.unpersist()


def test_derived_columns_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Surrogate keys, points and the marks of the load are added where facts are written."""
    from roadlake.sinks import packing

    lake, moved, real = Lake(spark, str(tmp_path / "lake")), [], packing.packed

    def packed(rows, *args):
        moved.append(set(rows.columns))
        return real(rows, *args)

    monkeypatch.setattr(packing, "packed", packed)
    dims = dimensions.seeded(spark)
    writers.load_incident_facts(rollups.collapsed(spark, SMALL), dims, lake, "s.0")
    writers.load_flow_facts(rollups.rollup(spark, SMALL), dims, lake, "s.0")
    added = {"incident_sk", "flow_sk", "geom", writers.LOADED, tables.SEQUENCE}
    assert len(moved) == 2 and not added & set.union(*moved)
    stored = lake.read(tables.FACT_INCIDENTS)
    assert stored.where("incident_sk IS NULL OR inserted_at IS NULL OR load_seq IS NULL OR (geom IS NULL) <> (lat IS NULL)").isEmpty()
    assert lake.read(tables.FACT_FLOW).where("flow_sk IS NULL").isEmpty()


def test_scan_tasks_are_small(spark, tmp_path):
    """16 MB of stored rows in one file, in row groups of 1 MB, are read by two tasks or more."""
    path = str(tmp_path / "rows")
    rows = spark.range(0, 2_000_000, 1, 1).select(F.xxhash64("id").alias("a"))
    rows.write.option("parquet.block.size", 1 << 20).option("compression", "uncompressed").parquet(path)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "8m"
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 2
