"""Stores the dimensions and adds the members they lack."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.operators import history
from roadlake.operators.merge import insert_if_absent
from roadlake.sinks import snapshots
from roadlake.sinks.lake import Lake
from roadlake.sources import dimensions
from roadlake.sources.tables import read_if_exists

FOLDER = "dimensions"
ADDED = "added-"


def folder(lake: Lake) -> str:
    return lake.path(FOLDER)


def bootstrap(lake: Lake) -> None:
    """Stores the seeded dimensions, keeping every row already there.

    What is missing is added as one file, so an interrupted bootstrap has added it or not, and
    repeating it adds nothing twice.
    """
    for name, seed in dimensions.seed_tables(lake.spark).items():
        _append_missing(lake, name, lambda stored, seed=seed: seed)


def add_days(lake: Lake, days: DataFrame) -> None:
    """Appends the days (``full_date``) that the stored calendar lacks, with their holidays, if one is stored."""
    if read_if_exists(lake.spark, f"{folder(lake)}/dim_date") is not None:
        _append_missing(lake, "dim_date", lambda stored: dimensions.calendar_rows(lake.spark, days))


def roll_locations(lake: Lake, observed: DataFrame) -> None:
    """Opens the versions of stored locations that observations ask for.

    ``observed`` has one row per ``location_key``: ``effective_date`` and any of the tracked
    columns; see ``history.roll_versions`` for what they change. New versions are one added file,
    and the versions before them end where they start, so a roll that breaks off has happened or
    not, a repeated one changes nothing, and of two at a time the second starts from what the
    first has left. Facts loaded afterwards carry the new keys.
    """
    tracked = [c for c in history.TRACKED if c in observed.columns]
    if not tracked:
        raise ValueError(f"none of {', '.join(history.TRACKED)} is observed")
    seen = observed.select("location_key", F.col("effective_date").cast("date").alias("effective_date"), *tracked)
    twice = seen.where("location_key IS NOT NULL").groupBy("location_key").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"several observations of {twice[0]}")

    def rolled(stored: DataFrame | None) -> DataFrame:
        if stored is None:
            raise ValueError("no locations are stored")
        return history.roll_versions(history.linked_versions(stored), seen, tracked=tracked)

    _append_missing(lake, "dim_location", rolled)


def _append_missing(lake: Lake, name: str, rows_for: Callable[[DataFrame | None], DataFrame]) -> None:
    """Adds what is missing as the next numbered file. Of two writers one gets the number; the
    other finds it taken and looks again at what is missing, so no row is added twice."""
    path, keys = f"{folder(lake)}/{name}", dimensions.CONFLICT_KEYS[name]
    store, at = snapshots.file_system(lake.spark, path), snapshots._path(lake.spark, path)
    for _ in range(snapshots.RETRIES):
        store.mkdirs(at)
        # The number is taken before the rows are read: what is added in between has it.
        added = [f.getPath().getName() for f in store.listStatus(at) if f.getPath().getName().startswith(ADDED)]
        number = max([int(n[len(ADDED) :].partition(".")[0]) for n in added], default=0) + 1
        stored = read_if_exists(lake.spark, path)
        rows = rows_for(stored)
        missing = rows if stored is None else insert_if_absent(stored.limit(0), rows.join(stored, keys, "left_anti"), keys)
        if missing.isEmpty():
            return
        draft = f"{lake.path('_drafts')}/{uuid.uuid4().hex}"
        missing.coalesce(1).write.parquet(draft)
        (part,) = [f.getPath() for f in store.listStatus(snapshots._path(lake.spark, draft)) if f.getPath().getName().startswith("part-")]
        done = snapshots.publish_file(lake.spark, part.toString(), f"{path}/{ADDED}{number:09d}.parquet")
        store.delete(snapshots._path(lake.spark, draft), True)
        if done:
            return
    raise RuntimeError(f"{snapshots.RETRIES} other writers were first in {path}")
