"""Figures observed while loads are written, summed instead of read."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from roadlake.catalog import rollups
from roadlake.catalog.storage import land_in_loads
from roadlake.operators import quality
from roadlake.session import fresh_folder
from roadlake.sinks import compaction, figures, writers
from roadlake.sinks import lake as tables
from roadlake.sinks.lake import Lake
from roadlake.sources import adapters, dimensions

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark):
    return Lake(spark, fresh_folder(spark, "figures"))


def from_rows(lake, table):
    columns = figures.asked(table)
    row = lake.read(table).agg(*[c.alias(f"f{i}") for i, c in enumerate(columns.values())]).first()
    return dict(zip(columns, row, strict=True))


def no_reading(monkeypatch):
    def refuse(*_):
        raise AssertionError("rows were read")

    monkeypatch.setattr(tables, "consistent", refuse)


def test_landing_figures_need_no_read(spark, lake, monkeypatch):
    land_in_loads(spark, SMALL, lake)
    expected = from_rows(lake, tables.LANDING_FLOW)
    assert expected["rows"] == adapters.flow_readings(spark, SMALL).count() and expected["closed_rows"] > 0
    compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.LANDING_FLOW])
    # The loads lost a day to the compacted one, so their other days are read.
    assert tables.table_figures(lake, tables.LANDING_FLOW) == expected
    compaction.compact_previous_day(lake, date(2024, 1, 3), [tables.LANDING_FLOW])
    no_reading(monkeypatch)
    assert tables.table_figures(lake, tables.LANDING_FLOW) == expected


def test_checks_of_facts_follow_what_counts(spark, lake, monkeypatch):
    rolled, dims = rollups.rollup(spark, SMALL).persist(), dimensions.seeded(spark)
    bad = rolled.withColumn("sample_count", F.lit(40000).cast(rolled.schema["sample_count"].dataType))
    writers.load_flow_facts(bad, dims, lake, "s.0")
    rule = "smallint(sample_count)"
    assert tables.table_figures(lake, tables.FACT_FLOW)[rule] == rolled.count()
    # One day is mended: those rows replace the bad ones, so that day is read and merged.
    writers.load_flow_facts(rolled.where("window_start < TIMESTAMP '2024-01-02'"), dims, lake, "s.1")
    expected = from_rows(lake, tables.FACT_FLOW)
    assert 0 < expected[rule] < rolled.count() and tables.table_figures(lake, tables.FACT_FLOW) == expected
    compaction.compact_previous_day(lake, date(2024, 1, 2), [tables.FACT_FLOW])
    compaction.compact_previous_day(lake, date(2024, 1, 3), [tables.FACT_FLOW])
    no_reading(monkeypatch)
    assert tables.table_figures(lake, tables.FACT_FLOW) == expected
    assert set(expected) == {"rows", *quality.row_checks("fact_traffic_flow")}
    rolled.unpersist()


def test_a_check_added_later_reads_older_loads(spark, lake, monkeypatch):
    land_in_loads(spark, SMALL, lake)
    monkeypatch.setitem(figures.REPORTS, tables.LANDING_FLOW, {**figures.REPORTS[tables.LANDING_FLOW], "fast_rows": "current_speed_kmh > 50"})
    expected = from_rows(lake, tables.LANDING_FLOW)
    assert expected["fast_rows"] > 0 and tables.table_figures(lake, tables.LANDING_FLOW) == expected


def test_a_load_that_changes_between_count_and_write_is_not_published(spark, lake, monkeypatch):
    readings = adapters.flow_readings(spark, SMALL)
    right = tables._measured

    def miscounted(*args):
        counted, parts = right(*args)
        return counted, {p: [n + 1, low, high] for p, (n, low, high) in parts.items()}

    monkeypatch.setattr(tables, "_measured", miscounted)
    with pytest.raises(RuntimeError, match="nothing was published"):
        writers.land(readings, lake, tables.LANDING_FLOW, "b0")
    assert lake.snapshot(tables.LANDING_FLOW).loads == [] and tables.table_figures(lake, tables.LANDING_FLOW) == {}


def test_figures_add_up():
    parts = [{"rows": 2, "first_ingested_at": 5, "last_ingested_at": 9}, {"rows": 0, "first_ingested_at": None, "last_ingested_at": None},
             {"rows": 3, "first_ingested_at": 4, "last_ingested_at": 6}]
    assert figures.summed(parts) == {"rows": 5, "first_ingested_at": 4, "last_ingested_at": 9}
    assert figures.summed([]) == {}
