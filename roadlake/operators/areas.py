"""Selection of points by rectangular area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.functions import codes, geo


def points_by_area(points: DataFrame, areas: list[tuple] = codes.AREAS, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row per point and area it lies in, with ``area``; points outside all areas drop out.

    The few areas are constants of the plan, so each row is tested where it is:
    no range join, no shuffle.
    """
    return points.withColumn("area", F.explode(geo.areas_at(F.col(lat), F.col(lon), areas)))


def points_in_box(
    points: DataFrame, min_lat: float, min_lon: float, max_lat: float, max_lon: float,
    lat: str = "lat", lon: str = "lon",
) -> DataFrame:
    """Points of one rectangle; the bounds reach the Parquet scan as pushed filters."""
    return points.where(F.col(lat).between(min_lat, max_lat) & F.col(lon).between(min_lon, max_lon))
