"""Merges, versioned dimension, quality checks."""

from datetime import date

from pyspark.sql import functions as F

from roadlake.operators import history, keys, merge, quality
from roadlake.sources import dimensions


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_latest_per_key_treats_nulls_as_equal(spark):
    frame = spark.createDataFrame([("a", None, 1, "x"), ("a", None, 2, "y"), ("b", 1, 1, "z")], "k string, j int, v int, p string")
    assert rows(merge.latest_per_key(frame, ["k", "j"], "v")) == [("a", None, 2, "y"), ("b", 1, 1, "z")]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 7), (None, 7)], "k string, v int")
    assert rows(merge.insert_if_absent(old, new, ["k"])) == rows(
        spark.createDataFrame([("a", 1), ("b", 2), (None, 7), (None, 7)], "k string, v int")
    )


def test_update_by_key_leaves_others(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", "d"), (3, "e", "f")], "k int, v string, w string")
    assert rows(merge.update_by_key(old, new, "k", ["v", "w"])) == [(1, "a", None), (2, "c", "d")]


def test_holidays_override_the_day_type(spark):
    dates = dimensions.date_dimension(dimensions.calendar_days(spark))
    updated = merge.update_by_key(
        dates, dimensions.holiday_updates(spark), "full_date", ["is_public_holiday", "holiday_name", "day_type"]
    )
    assert updated.count() == 1096
    assert updated.where("is_public_holiday").count() == 19
    assert updated.where("is_weekend").count() == 312
    friday = updated.where("full_date = DATE '2025-04-25'").first()  # a Friday
    assert friday.is_weekend and friday.day_type == "Holiday"


def test_calendar_covers_what_was_observed(spark):
    seen = spark.createDataFrame([(date(2023, 12, 30),), (date(2027, 1, 2),), (None,)], "day date")
    days = dimensions.calendar_days_covering(seen)
    assert tuple(days.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()) == (
        date(2023, 12, 30), date(2027, 1, 2), 1096 + 4,
    )
    nothing = dimensions.calendar_days_covering(seen.where("false"))
    assert nothing.count() == 1096


def test_slots(spark):
    slots = dimensions.time_dimension(spark)
    assert slots.count() == 96
    assert slots.where("is_peak_am").count() == 12 and slots.where("is_peak_pm").count() == 16
    assert slots.where("is_overnight").count() == 20 and slots.where("is_off_peak").count() == 48
    assert slots.where("time_key = 30").first().period_label == "07:30"


def test_new_versions(spark):
    dim = dimensions.location_dimension(spark)
    seen = spark.createDataFrame(
        [("tahrir_square", "FRC0", date(2025, 5, 1)), ("cairo_airport", "FRC1", date(2025, 5, 1)),
         ("giza_square", None, date(2025, 5, 1)), ("nowhere", "FRC5", date(2025, 5, 1))],
        "location_key string, frc string, effective_date date",
    )
    rolled = history.roll_versions(dim, seen, tracked=["frc"]).persist()
    assert rolled.count() == 24
    old, new = rolled.where("location_key = 'tahrir_square'").orderBy("version_number").collect()
    assert (old.frc, old.is_current, old.valid_to) == ("FRC2", False, date(2025, 5, 1))
    assert (new.frc, new.is_current, new.valid_to, new.valid_from) == ("FRC0", True, None, date(2025, 5, 1))
    assert new.version_number == 2 and new.location_sk != old.location_sk
    assert history.overlapping_versions(rolled).isEmpty()
    assert dimensions.current_versions(rolled).count() == 23
    again = history.roll_versions(rolled, seen, tracked=["frc"])
    assert again.exceptAll(rolled).isEmpty() and again.count() == 24
    rolled.unpersist()


def test_overlap_is_found(spark):
    dim = spark.createDataFrame(
        [("a", 1, date(2024, 1, 1), None), ("a", 2, date(2024, 2, 1), None)],
        "location_key string, version_number int, valid_from date, valid_to date",
    )
    assert history.overlapping_versions(dim).count() == 1
    gap = dim.withColumn("version_number", F.col("version_number") * 2 - 1)
    assert history.overlapping_versions(gap).count() == 1


def test_overlap_is_found_across_versions_and_months(spark):
    """Against all pairs: versions 1 and 3 that overlap, repeated numbers, gaps, many versions of one key."""
    rows = [("a", 1, date(2024, 1, 1), date(2024, 6, 1)), ("a", 2, date(2024, 1, 5), date(2024, 1, 6)), ("a", 3, date(2024, 3, 1), None)]
    rows += [("b", 1, date(2024, 1, 1), date(2024, 1, 9)), ("b", 2, date(2024, 1, 9), date(2024, 2, 1)), ("b", 2, date(2024, 2, 1), None)]
    rows += [("c", 1, date(2024, 1, 1), date(2024, 1, 2)), ("c", 3, date(2024, 5, 1), None), (None, 1, date(2024, 1, 1), None)]
    rows += [("hot", n + 1, date.fromordinal(738000 + 3 * n), date.fromordinal(738000 + 3 * n + (400 if n == 7 else 3))) for n in range(200)]
    dim = spark.createDataFrame(rows, "location_key string, version_number int, valid_from date, valid_to date")
    end = lambda r: r[3] or date(9999, 12, 31)
    expected = [
        r for r in rows
        if any(o[0] == r[0] and (o[2], o[1]) < (r[2], r[1]) and end(o) > r[2] for o in rows)
        or sum(o[:2] == r[:2] for o in rows) > 1 or r[1] > 1 and not any(o[0] == r[0] and o[1] == r[1] - 1 for o in rows)
    ]
    found = [tuple(r) for r in history.overlapping_versions(dim).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str) and len(found) > 130


def test_duplicate_current_version_would_duplicate_facts(spark):
    dim = spark.createDataFrame([("a", True), ("a", True), ("b", True)], "location_key string, is_current boolean")
    assert quality.duplicate_keys(dim.where("is_current"), "dim_location", ["location_key"]).first().violations == 1


def test_quality_checks_count_violations(spark):
    frame = spark.createDataFrame([(1, "abc", 40000), (None, "abcdef", 5), (7, None, None)], "q int, t string, s int")
    assert quality.null_violations(frame, "x", ["q", "t"]).collect() == [
        ("not_null(q)", "x", 1), ("not_null(t)", "x", 1),
    ]
    assert quality.range_violations(frame, "x", {"q": "q between 1 and 4"}).first().violations == 1
    assert [r.violations for r in quality.capacity_violations(frame, "x", {"t": 5}, ["s"]).collect()] == [1, 1]


def test_orphans_ignore_null_keys(spark):
    facts = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 9)], "a int, b int")
    ones = spark.createDataFrame([(1,)], "a int")
    dim_b = spark.createDataFrame([(1,)], "b int")
    assert merge.orphans(facts, ones, "a").count() == 2
    found = quality.orphan_counts(facts, "f", {"a": ones, "b": dim_b}).collect()
    assert found == [("foreign_key(a)", "f", 2), ("foreign_key(b)", "f", 1)]


def test_dimensions_are_broadcast_by_size_and_shuffled_beyond_it(spark):
    rollup = spark.createDataFrame(
        [("tahrir_square", 1704067200), ("nowhere", 1704068100), (None, 1704067200)], "location_name string, s long"
    ).select("location_name", F.timestamp_seconds("s").alias("window_start"))
    resolved = keys.resolve_flow_keys(rollup, dimensions.seeded(spark))
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = keys.resolve_flow_keys(rollup, dimensions.seeded(spark))
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert rows(shuffled) == rows(resolved)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
