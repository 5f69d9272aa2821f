"""Order of rows in compacted fact files, and which files a read can leave out.

A compaction orders the rows of a fact table by its layout: along a Z-order curve of position, so
that a file covers a small area, or by place and window. It then keeps the least and greatest
value of the layout's columns of every file in a small Parquet table beside the load. A read
within ranges takes from that table the files that may hold such rows and lists no others. Inside
a file, Parquet's own statistics of row groups and pages do the same on the ordered columns, and
Bloom filters on the surrogate keys, which no order helps.

Files are cut by ranges of the order, with a hash of the row's key as its last part: a place that
holds a third of all rows is spread over files.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.sinks import packing

COORDINATE_BITS = 31
# (shift, mask) by turns: the bits of a number move to every second place of a long.
SPREAD = [
    (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333), (1, 0x5555555555555555),
]


@dataclass(frozen=True)
class Layout:
    """Columns with a known range per file, whether they are ordered along the curve, and
    columns with Bloom filters."""

    ranges: dict[str, str]  # column -> type
    along_curve: bool = False
    blooms: list[str] = field(default_factory=list)

    def order(self) -> list[Column]:
        columns = [F.col(c) for c in self.ranges]
        return [z_order(*columns)] if self.along_curve else columns

    def options(self) -> dict[str, str]:
        """Writer options; the size of a filter adapts to the distinct values it gets."""
        on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.blooms}
        return {**on, "parquet.bloom.filter.adaptive.enabled": "true"} if on else {}

    def schema(self) -> T.StructType:
        kept = [f"{end}_{c} {kind}" for c, kind in self.ranges.items() for end in ("low", "high")]
        return T.StructType.fromDDL(", ".join(["attempt string", "name string", "row_count long", *kept]))


LAYOUTS = {
    "facts/fact_traffic_flow": Layout({"location_name": "string", "window_start_utc": "timestamp"}, blooms=["flow_sk"]),
    "facts/fact_incidents": Layout({"lat": "double", "lon": "double"}, along_curve=True, blooms=["incident_sk"]),
}


def _cell(value: Column, low: float, high: float) -> Column:
    """Number of the value's cell in a grid; what lies outside counts as the edge."""
    share = (F.greatest(F.least(value, F.lit(high)), F.lit(low)) - low) / (high - low)
    return F.floor(share * F.lit(float((1 << COORDINATE_BITS) - 1))).cast("long")


def _spread(cell: Column) -> Column:
    for shift, mask in SPREAD:
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask))
    return cell


def z_order(lat: Column, lon: Column) -> Column:
    """Place of a position on the Z-order curve; NULL without one."""
    place = F.shiftleft(_spread(_cell(lat, -90.0, 90.0)), 1).bitwiseOR(_spread(_cell(lon, -180.0, 180.0)))
    return F.when(lat.isNotNull() & lon.isNotNull(), place)


def file_count(stored_bytes: int) -> int:
    return max(1, math.ceil(stored_bytes / packing.FILE_BYTES))


def clustered(rows: DataFrame, layout: Layout, files: int, first: list[str], key: list[str]) -> DataFrame:
    """The rows in the order of the layout, cut into ``files`` ranges; ``first`` are constants."""
    order = [*layout.order(), F.xxhash64(*key)]
    cut = rows.repartitionByRange(files, *order) if files > 1 else rows.coalesce(1)
    return cut.sortWithinPartitions(*first, *order)


def file_ranges(rows: DataFrame, layout: Layout, attempt: str) -> DataFrame:
    """One row per file of the stored rows of an attempt."""
    path = F.col("_metadata.file_path")
    name = F.substring_index(path, f"attempt={attempt}/", -1)
    ends = [f(c).cast(kind).alias(f"{end}_{c}") for c, kind in layout.ranges.items() for end, f in (("low", F.min), ("high", F.max))]
    counted = rows.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("row_count"), *ends)
    return counted.select(F.lit(attempt).alias("attempt"), *counted.columns)


def may_hold(layout: Layout, ranges: dict[str, tuple]) -> Column:
    """Whether a file may hold rows within all ranges; one without any value of a column has none."""
    found = F.lit(True)
    for column, (low, high) in ranges.items():
        if column in layout.ranges:
            found &= (F.col(f"low_{column}") <= F.lit(high)) & (F.col(f"high_{column}") >= F.lit(low))
    return found


def within(ranges: dict[str, tuple]) -> Column:
    found = F.lit(True)
    for column, (low, high) in ranges.items():
        found &= F.col(column).between(F.lit(low), F.lit(high))
    return found
