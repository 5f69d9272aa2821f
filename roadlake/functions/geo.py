"""Points and areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions import codes

SRID = 4326


def point(lat: Column, lon: Column) -> Column:
    """Point struct with its WKT text; NULL unless both coordinates are known."""
    wkt = F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
    value = F.struct(lon.alias("lon"), lat.alias("lat"), F.lit(SRID).alias("srid"), wkt.alias("wkt"))
    return F.when(lat.isNotNull() & lon.isNotNull(), value)


def areas_at(lat: Column, lon: Column, areas: list[tuple] = codes.AREAS) -> Column:
    """Names of all areas a point lies in, edges included. Areas may overlap."""
    hits = [
        F.when(lat.between(lat0, lat1) & lon.between(lon0, lon1), F.lit(name))
        for name, _city, lat0, lon0, lat1, lon1 in areas
    ]
    return F.array_compact(F.array(*hits))
