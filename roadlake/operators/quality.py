"""Data-quality checks: each returns rows (rule, table_name, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALLINT = (-32768, 32767)

# Allowed ranges, text lengths and small-integer columns per table.
RANGES = {
    "dim_date": {
        "quarter": "quarter between 1 and 4",
        "month": "month between 1 and 12",
        "week_of_year": "week_of_year between 1 and 53",
        "day_of_month": "day_of_month between 1 and 31",
        "day_of_week": "day_of_week between 1 and 7",
    },
    "dim_time": {"hour": "hour between 0 and 23", "minute": "minute in (0, 15, 30, 45)"},
    "fact_incidents": {"magnitude": "magnitude between 0 and 4"},
}
TEXT_LENGTHS = {
    "dim_date": {"month_name_en": 10, "month_name_ar": 20, "day_name_en": 10, "day_name_ar": 20,
                 "holiday_name": 100, "season": 10, "day_type": 20},
    "dim_time": {"period_label": 10},
    "dim_location": {"location_key": 100, "location_name": 100, "city": 50, "governorate": 50,
                     "area_zone": 100, "road_type": 50, "frc": 5, "frc_label": 50},
    "dim_incident_category": {"category_key": 50, "category_raw": 100, "category_label_en": 100,
                              "category_label_ar": 100, "category_group": 50, "severity_level": 20},
    "fact_traffic_flow": {"frc_code": 5, "frc_label": 50, "congestion_level": 20, "confidence_band": 10},
    "fact_incidents": {"road_numbers": 100, "magnitude_label": 20},
}
SMALL_INTEGERS = {
    "dim_date": ["year", "quarter", "month", "week_of_year", "day_of_month", "day_of_week"],
    "dim_time": ["time_key", "hour", "minute"],
    "dim_location": ["version_number"],
    "dim_incident_category": ["icon_category_id", "severity_rank"],
    "fact_traffic_flow": ["time_key", "min_speed_kmh", "max_speed_kmh", "sample_count"],
    "fact_incidents": ["time_key", "magnitude"],
}
NOT_NULL = {
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "month_name_en", "month_name_ar", "week_of_year",
                 "day_of_month", "day_of_week", "day_name_en", "day_name_ar", "is_weekend",
                 "is_public_holiday", "is_ramadan", "is_school_term", "season", "day_type"],
    "dim_time": ["time_key", "hour", "minute", "period_label", "is_peak_am", "is_peak_pm", "is_off_peak", "is_overnight"],
    "dim_location": ["location_sk", "location_key", "version_number", "location_name", "city", "valid_from", "is_current"],
    "dim_incident_category": ["category_sk", "category_key", "category_raw", "category_label_en", "category_group",
                              "severity_level", "severity_rank", "causes_road_closure"],
    "fact_traffic_flow": ["date_key", "time_key", "window_start_utc", "window_end_utc"],
    "fact_incidents": ["date_key", "time_key", "window_start_utc", "has_known_location", "delay_seconds",
                       "length_meters", "is_road_closure", "is_active_at_ingestion"],
}
UNIQUE = {
    "dim_date": [["date_key"], ["full_date"]],
    "dim_time": [["time_key"], ["hour", "minute"]],
    "dim_location": [["location_sk"], ["location_key", "version_number"]],
    "dim_incident_category": [["category_sk"], ["category_key"], ["category_raw"]],
    "fact_traffic_flow": [["date_key", "time_key", "location_sk"]],
}


def _counted(rows: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """One pass over the table for all its checks, then one row per check."""
    counts = rows.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
    found = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.col(f"c{i}").alias("violations"))
            for i, rule in enumerate(checks)
        ]
    )
    return counts.select(F.inline(found))


def row_checks(table: str) -> dict[str, Column]:
    """All checks of a table that look at one row, by rule: what violates it."""
    checks = {f"not_null({c})": F.col(c).isNull() for c in NOT_NULL.get(table, [])}
    checks |= {f"range({c})": ~F.expr(allowed) for c, allowed in RANGES.get(table, {}).items()}
    checks |= {f"length({c})": F.char_length(c) > limit for c, limit in TEXT_LENGTHS.get(table, {}).items()}
    checks |= {f"smallint({c})": ~F.col(c).between(*SMALLINT) for c in SMALL_INTEGERS.get(table, [])}
    return checks


def null_violations(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _counted(rows, table, {f"not_null({c})": F.col(c).isNull() for c in columns})


def range_violations(rows: DataFrame, table: str, ranges: dict[str, str]) -> DataFrame:
    """A NULL is no range violation."""
    return _counted(rows, table, {f"range({c})": ~F.expr(allowed) for c, allowed in ranges.items()})


def capacity_violations(
    rows: DataFrame, table: str, text_lengths: dict[str, int], small_integers: list[str]
) -> DataFrame:
    checks = {f"length({c})": F.char_length(c) > limit for c, limit in text_lengths.items()}
    checks |= {f"smallint({c})": ~F.col(c).between(*SMALLINT) for c in small_integers}
    return _counted(rows, table, checks)


def duplicate_keys(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of key values held by more than one row; a key with a NULL part is distinct."""
    known = rows.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    repeated = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return repeated.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit(f"unique({', '.join(keys)})").alias("rule"), F.lit(table).alias("table_name"), "violations"
    )


def orphan_counts(facts: DataFrame, table: str, references: dict[str, DataFrame]) -> DataFrame:
    """Rows per foreign key (``key -> dimension``) whose member the dimension lacks; NULL is no reference.

    All keys of the table are checked in one pass: its rows are first counted per
    combination of keys, and only those few meet the dimensions.
    """
    used = facts.groupBy(*references).agg(F.count(F.lit(1)).alias("n"))
    for key, dimension in references.items():
        members = dimension.select(F.col(key).alias(f"_{key}")).distinct()
        used = used.join(members, used[key] == members[f"_{key}"], "left")
    lost = {key: F.col(key).isNotNull() & F.col(f"_{key}").isNull() for key in references}
    counts = used.agg(*[F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias(k) for k, bad in lost.items()])
    found = F.array(
        *[
            F.struct(F.lit(f"foreign_key({k})").alias("rule"), F.lit(table).alias("table_name"),
                     F.col(k).alias("violations"))
            for k in references
        ]
    )
    return counts.select(F.inline(found))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
