"""Insert-if-absent, keyed update, latest-wins merge, orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def latest_per_key(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the greatest ``version`` per key; NULL keys are equal.

    An aggregation, not a ranking window: duplicates of a hot key are reduced on
    the map side and never meet in one task.
    """
    rest = [c for c in rows.columns if c not in keys and c != version]
    newest = rows.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows plus the incoming ones whose key is new.

    Incoming duplicates of a key collapse to one row. NULL keys never conflict, so
    such rows are always inserted.
    """
    rest = [c for c in incoming.columns if c not in keys]
    keyed = incoming.where(_all_known(keys))
    single = keyed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")) if rest else keyed.select(*keys).distinct()
    if rest:
        single = single.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in incoming.columns])
    new = single.join(existing.select(*keys), keys, "left_anti").select(*incoming.columns)
    unkeyed = incoming.where(~_all_known(keys))
    return existing.unionByName(new).unionByName(unkeyed)


def update_by_key(rows: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with ``columns`` replaced where ``updates`` has their key (at most once)."""
    new = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = rows.join(new, rows[key] == new["_key"], "left")
    return joined.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns]
    )


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Union of both, the greatest ``version`` winning per key."""
    return latest_per_key(existing.unionByName(incoming), keys, version)


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows with a key their dimension lacks; a NULL key is no reference."""
    return facts.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
