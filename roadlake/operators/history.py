"""Versioned location dimension (slowly changing, type 2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.functions import codes
from roadlake.functions.lookup import label_of, road_class_label

TRACKED = ["road_type", "frc", "frc_label"]


def derived_from_class(frc: Column) -> dict[str, Column]:
    """What follows from the road class."""
    return {"road_type": label_of(frc, codes.ROAD_TYPE_OF_CLASS, "local"), "frc_label": road_class_label(frc)}


def roll_versions(
    dimension: DataFrame, observed: DataFrame, key: str = "location_key", tracked: list[str] = TRACKED,
    effective: str = "effective_date", surrogate: str = "location_sk",
) -> DataFrame:
    """Closes current versions whose tracked values changed and opens the next ones.

    ``observed`` has one row per key: the tracked values now seen and the day they
    took effect. A NULL observation changes nothing, nor does one that is not later than
    the start of the current version: it would end it before it began. Columns that follow from
    the road class follow the new one unless they are tracked themselves. The closed version ends on the
    day the new one starts and the new one gets a surrogate key of its own, a stable
    64-bit hash of key and version. One join; closed and new rows come from the same
    matched row, so the dimension is read once.
    """
    seen = observed.select(
        F.col(key).alias("_key"), F.col(effective).alias("_from"), *[F.col(c).alias(f"_new_{c}") for c in tracked]
    )
    differs = reduce(
        lambda a, b: a | b,
        [F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(c)) for c in tracked],
    )
    differs = differs & (F.col("_from") > F.col("valid_from"))
    matched = dimension.join(seen, (dimension[key] == seen["_key"]) & dimension["is_current"], "left")
    marked = matched.withColumn("_changed", F.coalesce(differs, F.lit(False)) & F.col("_key").isNotNull())
    kept = F.struct(
        *[
            F.when(F.col("_changed"), F.col("_from")).otherwise(F.col("valid_to")).alias(c)
            if c == "valid_to"
            else (F.col("is_current") & ~F.col("_changed")).alias(c)
            if c == "is_current"
            else F.col(c)
            for c in dimension.columns
        ]
    )
    fresh = {
        surrogate: F.xxhash64(F.col(key), F.col("version_number") + 1),
        "version_number": F.col("version_number") + 1,
        "valid_from": F.col("_from"),
        "valid_to": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        **{c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in tracked},
    }
    if "frc" in tracked:
        new_class = F.coalesce(F.col("_new_frc"), F.col("frc"))
        for name, value in derived_from_class(new_class).items():
            if name not in tracked and name in dimension.columns:
                fresh[name] = value
    opened = F.struct(*[fresh[c].alias(c) if c in fresh else F.col(c) for c in dimension.columns])
    versions = F.when(F.col("_changed"), F.array(kept, opened)).otherwise(F.array(kept))
    return marked.select(F.explode(versions).alias("v")).select("v.*")


def linked_versions(dimension: DataFrame, key: str = "location_key") -> DataFrame:
    """Versions as their successors leave them: a version ends where the next one starts.

    With it a stored dimension only ever grows. Opening a version is one added row, and no
    stored row has to be closed in the same breath. NULL keys have no successors.
    """
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("version_number"))
    successor = F.when(F.col(key).isNotNull(), following)
    return dimension.withColumns(
        {"valid_to": F.least(F.col("valid_to"), successor), "is_current": F.col("is_current") & successor.isNull()}
    )


def overlapping_versions(dimension: DataFrame, key: str = "location_key") -> DataFrame:
    """Versions that start before any earlier one of their key ended, repeat a version number, or
    lack the number before theirs.

    A sweep in order of start with the running maximum of the ends, so an overlap is found
    however many versions lie between. A key's versions are swept month by month: each month
    starts from the maximum of the months before, so a key with very many versions is spread
    over tasks and only one row per key and month meets in its window.
    """
    ended = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    rows = dimension.withColumns({"_ended": ended, "_month": F.date_trunc("month", "valid_from").cast("date")})
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    months = rows.groupBy(key, "_month").agg(F.max("_ended").alias("_most"))
    carried = months.select(
        F.col(key).alias("_key"), F.col("_month").alias("_in"), F.max("_most").over(earlier(key).orderBy("_month")).alias("_before")
    )
    within = earlier(key, "_month").orderBy("valid_from", "version_number", "_ended")
    numbers = dimension.groupBy(F.col(key).alias("_of"), F.col("version_number").alias("_number")).agg(F.count(F.lit(1)).alias("_times"))
    swept = rows.withColumn("_reached", F.max("_ended").over(within)).join(
        carried, rows[key].eqNullSafe(F.col("_key")) & rows["_month"].eqNullSafe(F.col("_in")), "left"
    )
    same, before = numbers.alias("same"), numbers.select(F.col("_of").alias("_of2"), F.col("_number").alias("_number2"))
    swept = swept.join(same, swept[key].eqNullSafe(F.col("_of")) & (F.col("version_number") == F.col("_number")), "left")
    swept = swept.join(before, swept[key].eqNullSafe(F.col("_of2")) & (F.col("version_number") - 1 == F.col("_number2")), "left")
    overlap = F.coalesce(F.greatest("_reached", "_before") > F.col("valid_from"), F.lit(False))
    repeated = F.coalesce(F.col("_times") > 1, F.lit(False))
    gap = F.col("_number2").isNull() & (F.col("version_number") > 1)
    return swept.where(overlap | repeated | gap).select(*[swept[c] for c in dimension.columns])
