"""Dimension tables: generators, seeds and scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions import calendar, codes, geo
from roadlake.functions.lookup import inline_table, label_of, road_class_label
from roadlake.operators.history import linked_versions
from roadlake.operators.merge import update_by_key

DATE_COLUMNS = ["date_key", "full_date"]
LOCATION_COLUMNS = ["location_sk", "location_key"]
CATEGORY_COLUMNS = ["category_sk", "category_raw"]


@dataclass(frozen=True)
class Dimensions:
    """The joinable dimensions. Slots need none: a slot's key follows from the time."""

    date: DataFrame
    location: DataFrame
    category: DataFrame

    def lookups(self) -> "Dimensions":
        """Only current versions and the columns a key lookup reads."""
        return Dimensions(
            self.date.select(*DATE_COLUMNS),
            current_versions(self.location).select(*LOCATION_COLUMNS),
            self.category.select(*CATEGORY_COLUMNS),
        )


def current_versions(location: DataFrame) -> DataFrame:
    return location.where("is_current")


def calendar_days(
    spark: SparkSession, first: str = codes.CALENDAR_FIRST_DAY, last: str = codes.CALENDAR_LAST_DAY
) -> DataFrame:
    """The ``full_date`` series of a fixed span."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date")
    )


def calendar_days_covering(
    observed: DataFrame, first: str = codes.CALENDAR_FIRST_DAY, last: str = codes.CALENDAR_LAST_DAY
) -> DataFrame:
    """The ``full_date`` series over a fixed span, widened to every day in ``observed.day``.

    Facts then never fall outside the calendar. Only the two extreme days leave
    the aggregation, so the series is built from one row.
    """
    span = observed.agg(
        F.least(F.min("day"), F.lit(first).cast("date")).alias("first"),
        F.greatest(F.max("day"), F.lit(last).cast("date")).alias("last"),
    )
    return span.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def date_dimension(days: DataFrame) -> DataFrame:
    return days.select(*[c.alias(n) for n, c in calendar.day_attributes(F.col("full_date")).items()])


def holiday_updates(spark: SparkSession) -> DataFrame:
    """One row per public holiday: the values it sets on its day."""
    rows = [
        (f"{year}-{month:02d}-{day:02d}", True, name, "Holiday")
        for month, day, name, years in codes.PUBLIC_HOLIDAYS
        for year in years
    ]
    raw = inline_table(spark, "full_date, is_public_holiday, holiday_name, day_type", rows)
    return raw.withColumn("full_date", F.col("full_date").cast("date"))


def time_dimension(spark: SparkSession) -> DataFrame:
    slots = spark.range(24 * 60 // codes.WINDOW_MINUTES).select(F.col("id").cast("int").alias("slot"))
    return slots.select(*[c.alias(n) for n, c in calendar.slot_attributes(F.col("slot")).items()])


def category_dimension(spark: SparkSession) -> DataFrame:
    rows = [(sk, *row) for sk, row in enumerate(codes.CATEGORY_SEED, start=1)]
    return inline_table(
        spark,
        "category_sk, category_key, category_raw, icon_category_id, category_label_en, category_label_ar, "
        "category_group, severity_level, severity_rank, causes_road_closure",
        rows,
    )


def location_dimension(spark: SparkSession) -> DataFrame:
    rows = [(sk, *row) for sk, row in enumerate(codes.LOCATION_SEED, start=1)]
    seed = inline_table(
        spark, "location_sk, location_key, location_name, governorate, area_zone, frc, lat, lon", rows
    )
    return seed.select(
        F.col("location_sk").cast("long").alias("location_sk"),
        "location_key",
        F.lit(1).alias("version_number"),
        "location_name",
        label_of(F.col("governorate"), codes.CITY_OF_GOVERNORATE, codes.UNKNOWN_CITY).alias("city"),
        "governorate",
        "area_zone",
        label_of(F.col("frc"), codes.ROAD_TYPE_OF_CLASS, "local").alias("road_type"),
        "frc",
        road_class_label(F.col("frc")).alias("frc_label"),
        "lat",
        "lon",
        geo.point(F.col("lat"), F.col("lon")).alias("geom"),
        F.lit(codes.LOCATION_VALID_FROM).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def seeded(spark: SparkSession) -> Dimensions:
    """The dimensions as first seeded, without any table to read."""
    return Dimensions(date_dimension(calendar_days(spark)), location_dimension(spark), category_dimension(spark))


TABLES = ["dim_date", "dim_time", "dim_location", "dim_incident_category"]
CONFLICT_KEYS = {
    "dim_date": ["date_key"],
    "dim_time": ["time_key"],
    "dim_location": ["location_key", "version_number"],
    "dim_incident_category": ["category_raw"],
}


def calendar_rows(spark: SparkSession, days: DataFrame) -> DataFrame:
    """Rows of ``dim_date`` for the days, public holidays included."""
    return update_by_key(
        date_dimension(days), holiday_updates(spark), "full_date", ["is_public_holiday", "holiday_name", "day_type"]
    )


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All four dimension tables as first stored, public holidays included."""
    tables = [calendar_rows(spark, calendar_days(spark)), time_dimension(spark), location_dimension(spark), category_dimension(spark)]
    return dict(zip(TABLES, tables))


def stored(spark: SparkSession, folder: str) -> Dimensions:
    """The stored dimensions as they are now, rolled versions included."""
    date, location, category = (
        spark.read.parquet(f"{folder}/{t}") for t in ("dim_date", "dim_location", "dim_incident_category")
    )
    return Dimensions(date, linked_versions(location), category)


def scan_dimension(
    spark: SparkSession, source: str, columns: list[str], jdbc: dict | None = None
) -> DataFrame:
    """Columns of a stored dimension: a Parquet path, or a table over JDBC.

    The projection reaches the scan in both cases. JDBC needs a driver jar.
    """
    if jdbc is None:
        return spark.read.parquet(source).select(*columns)
    return spark.read.format("jdbc").options(**jdbc).option("dbtable", source).load().select(*columns)
