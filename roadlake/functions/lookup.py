"""Small helpers over code lists and carried values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.functions import codes


def literal(value) -> str:
    """A Python constant as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def constants(kind: str, values: list) -> Column:
    """``array`` or ``map`` of constants, as one SQL literal rather than a column per value."""
    return F.expr(f"{kind}({', '.join(literal(v) for v in values)})")


def inline_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A table of constants. Its size is known to the optimizer, so joins with it need no shuffle."""
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS seed({columns})")


def nth(values: list, position: Column) -> Column:
    """The value at a 0-based position of a constant list."""
    return F.element_at(constants("array", values), position.cast("int") + 1)


def label_of(key: Column, labels: dict, default: str) -> Column:
    """Label of a code, ``default`` for unknown and NULL codes.

    The list is a constant of at most 25 entries, so it is folded into the plan
    as a map literal: no join, no shuffle, and a NULL or hot key costs nothing.
    """
    entries = constants("map", list(chain.from_iterable(labels.items())))
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))


def banded(value: Column, bands: list[tuple[float, str]], floor: str) -> Column:
    """First band whose lower bound the value reaches, highest band first."""
    out = F.lit(floor)
    for bound, label in reversed(bands):
        out = F.when(value >= F.lit(bound), F.lit(label)).otherwise(out)
    return out


def city_of(place: Column) -> Column:
    """City of a monitored point or incident area."""
    return label_of(place, codes.CITY_OF_PLACE, codes.UNKNOWN_CITY)


def road_class_label(frc: Column) -> Column:
    return label_of(frc, codes.ROAD_CLASSES, codes.UNKNOWN_LABEL)


def magnitude_label(magnitude: Column) -> Column:
    return label_of(magnitude, codes.MAGNITUDES, codes.UNKNOWN_LABEL)


def category_name(icon_category_id: Column) -> Column:
    return label_of(icon_category_id, codes.CATEGORIES, codes.UNKNOWN_LABEL)


def earliest_known(value: str, at: str = "event_time") -> Column:
    """Aggregate: the non-NULL value of the earliest row, smallest value on a tie.

    It does not depend on arrival order, unlike ``first``, and ``min`` merges
    partial results, so a hot group is reduced before the shuffle.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(at).alias("at"), F.col(value).alias("value")))
    return F.min(known)["value"]


# Room per second of a window: all 32-bit values, moved to start from 0.
_ROOM = 1 << 32


def packed(value: str, at: str = "event_time") -> Column:
    """Second within the window and a 32-bit value or flag in one long, NULL if the value is.

    The smallest long is the earliest known value, smallest on a tie, as ``earliest_known``
    finds it. Its buffer has a fixed width, so Spark hashes groups instead of sorting rows.
    """
    second = F.pmod(F.unix_seconds(F.col(at)), F.lit(codes.WINDOW_MINUTES * 60))
    return second * F.lit(_ROOM) + F.col(value).cast("long") + F.lit(_ROOM // 2)


def unpacked(number: Column, data_type: T.DataType) -> Column:
    """The value in a packed number."""
    value = F.pmod(number, F.lit(_ROOM)) - F.lit(_ROOM // 2)
    return value == 1 if isinstance(data_type, T.BooleanType) else value.cast(data_type)
