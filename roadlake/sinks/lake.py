"""Table layout, loads that are seen whole, and compaction that loses nothing.

Every table below ``root`` is Parquet partitioned by ``attempt``, day and ``load``, without a
file-sink log, so batch jobs may rewrite it. What counts is named by the table's newest version
(see ``snapshots``); attempts that no version names are neither listed nor read.

* Each write of a load is an attempt in a folder of its own, which also keeps jobs that write at
  once apart. It counts once its version is published. A load that is delivered again takes
  the place of its earlier attempt in one step.
* Compaction copies the loads of a day into one new load beside them, checks that the row counts
  are equal, and publishes a version in which the new load stands for them. The replaced
  loads are remembered (as ranges of batches), so one that is written late, or delivered
  again at any time, is left out. A crash leaves files that no version names.
* Replaced files are removed by the next compaction, once no version that names them is younger
  than ``keep_seconds``.
* Compacted fact files are ordered and have known ranges (see ``layout``), so a read within ranges lists
  only those that may hold such rows. Where loads overlap all files are read: the row that counts
  may lie outside the ranges of the one it replaces.
* Fact tables are merged by key on reading: of the rows of one key, the load with the highest
  sequence number counts. Loads are numbered when they first appear, so a repeated load keeps its
  place and no clock decides. Only days with loads whose ranges of keys overlap are merged; the
  others are read as they are.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.operators import keys, merge
from roadlake.sinks import figures, layout, packing, snapshots
from roadlake.sinks.snapshots import Load, Snapshot

LOAD = "load"
ATTEMPT = "attempt"
SEQUENCE = "load_seq"
COMPACTED = "compacted-"
DAYS = ["year", "month", "day"]
DATE_KEY = ["date_key"]

LANDING_FLOW = "landing/flow"
LANDING_INCIDENTS = "landing/incidents"
SILVER_FLOW = "silver/flow"
SILVER_INCIDENTS = "silver/incidents"
FACT_FLOW = "facts/fact_traffic_flow"
FACT_INCIDENTS = "facts/fact_incidents"
QUARANTINE = "quarantine"
DEAD_LETTERS = [f"{QUARANTINE}/{s}" for s in ("flow", "incidents", "fact_traffic_flow", "fact_incidents")]
COMPACTED_TABLES = [LANDING_FLOW, LANDING_INCIDENTS, SILVER_FLOW, SILVER_INCIDENTS, FACT_FLOW, FACT_INCIDENTS, *DEAD_LETTERS]

FACT_KEYS = {
    FACT_FLOW: [*DATE_KEY, *keys.FLOW_IDENTITY],
    FACT_INCIDENTS: [*DATE_KEY, *keys.INCIDENT_IDENTITY],
}
# Part of every fact key; loads of a day whose ranges of it are apart have no key in common.
RANGE_KEY = "window_start_utc"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partitions(table: str) -> list[str]:
    """Time partitions of a table; compaction takes one of them."""
    return DATE_KEY if table in FACT_KEYS else DAYS


@dataclass(frozen=True)
class Lake:
    """A folder of tables that all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def versions(self, table: str) -> str:
        return f"{self.root}/_versions/{table}"

    def snapshot(self, table: str) -> Snapshot:
        return snapshots.latest(self.spark, self.versions(table))

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"

    def read(self, table: str) -> DataFrame:
        """The rows that count, one per key in fact tables."""
        snapshot, rows = consistent(self, table)
        if not snapshot.loads:
            raise AnalysisException(f"[PATH_NOT_FOUND] table {table} of {self.root} has no rows")
        if table not in FACT_KEYS:
            return visible(snapshot, rows).drop(ATTEMPT)
        return merged(snapshot, table, visible(snapshot, rows)).drop(ATTEMPT)

    def read_within(self, table: str, ranges: dict[str, tuple]) -> DataFrame:
        """The rows that count and have each column between its two bounds, ends included."""
        snapshot, rows = consistent(self, table, ranges)
        if not snapshot.loads:
            raise AnalysisException(f"[PATH_NOT_FOUND] table {table} of {self.root} has no rows")
        rows = visible(snapshot, rows)
        if table in FACT_KEYS:
            rows = merged(snapshot, table, rows)
        return rows.drop(ATTEMPT).where(layout.within(ranges))

    def read_if_exists(self, table: str) -> DataFrame | None:
        return self.read(table) if self.snapshot(table).loads else None


def with_day(rows: DataFrame, at: Column) -> DataFrame:
    return rows.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


# --- reading ---------------------------------------------------------------------


def attempt_folder(lake: Lake, table: str, attempt: str) -> str:
    return f"{lake.path(table)}/{ATTEMPT}={attempt}"


def ranges_folder(lake: Lake, table: str, attempt: str) -> str:
    """Where the ranges of an attempt's files are kept."""
    return f"{lake.root}/_files/{table}/{attempt}"


def stored_rows(lake: Lake, table: str, schema: str, paths: list[str]) -> DataFrame:
    """Every stored row of the files or folders."""
    fields = T.StructType.fromJson(json.loads(schema))
    if not paths:
        last = [ATTEMPT, *partitions(table), LOAD]  # as Spark orders what it takes from folders
        return lake.spark.createDataFrame([], fields).select(*[c for c in fields.names if c not in last], *last)
    return lake.spark.read.schema(fields).option("basePath", lake.path(table)).parquet(*paths)


def paths_within(lake: Lake, table: str, snapshot: Snapshot, ranges: dict[str, tuple] | None) -> list[str]:
    """The folders of the loads; of loads whose files have known ranges, only files that may hold
    rows within ``ranges``, except on days where loads overlap."""
    doubtful = set(overlapping_partitions(snapshot)) if ranges else set()
    narrow = [x.attempt for x in snapshot.loads if ranges and x.ranged and not doubtful & set(x.parts)]
    paths = [attempt_folder(lake, table, x.attempt) for x in snapshot.loads if x.attempt not in set(narrow)]
    if narrow:
        kept = lake.spark.read.schema(layout.LAYOUTS[table].schema()).parquet(*[ranges_folder(lake, table, a) for a in narrow])
        found = kept.where(layout.may_hold(layout.LAYOUTS[table], ranges)).select("attempt", "name").collect()
        paths += [f"{attempt_folder(lake, table, x.attempt)}/{x.name}" for x in found]
    return paths


def consistent(lake: Lake, table: str, ranges: dict[str, tuple] | None = None) -> tuple[Snapshot, DataFrame | None]:
    """A version and the files listed for it: listed again if what it names was retired meanwhile."""
    while True:
        snapshot = lake.snapshot(table)
        if not snapshot.loads:
            return snapshot, None
        try:
            rows = stored_rows(lake, table, snapshot.schema, paths_within(lake, table, snapshot, ranges))  # lists the files
        except AnalysisException:
            if lake.snapshot(table).version == snapshot.version:
                raise
            continue
        if snapshot.attempts() <= lake.snapshot(table).attempts():
            return snapshot, rows


def _in_partition(partition: str) -> Column:
    terms = [
        F.col(k).isNull() if v == NO_VALUE else F.col(k) == int(v)
        for k, _, v in (level.partition("=") for level in partition.split("/"))
    ]
    return reduce(lambda a, b: a & b, terms)


def visible(snapshot: Snapshot, rows: DataFrame) -> DataFrame:
    """Without the days of an attempt that no longer count: a filter on partitions only."""
    live = {x.attempt for x in snapshot.loads}
    gone: dict[str, list[str]] = {}
    for partition, _, attempt in snapshot.retired:
        if attempt in live:
            gone.setdefault(partition, []).append(attempt)
    for partition, attempts in gone.items():
        rows = rows.where(~(_in_partition(partition) & F.col(ATTEMPT).isin(attempts)))
    return rows


def _overlap(spans: list[tuple]) -> bool:
    """Whether two ranges (low, high) have a value in common; a range without values may have any."""
    if len(spans) > 1 and any(low is None for low, _ in spans):
        return True
    reached = None
    for low, high in sorted(spans):
        if reached is not None and low <= reached:
            return True
        reached = high if reached is None else max(reached, high)
    return False


def overlapping_partitions(snapshot: Snapshot) -> list[str]:
    """The partitions in which two loads may have a key in common."""
    spans: dict[str, list] = {}
    for load in snapshot.loads:
        for partition, (_, low, high) in load.parts.items():
            spans.setdefault(partition, []).append((low, high))
    return [p for p, s in spans.items() if _overlap(s)]


def merged(snapshot: Snapshot, table: str, rows: DataFrame) -> DataFrame:
    """One row per key; only days with overlapping loads are grouped."""
    doubtful = [int(p.partition("=")[2]) for p in overlapping_partitions(snapshot)]
    if not doubtful:
        return rows
    apart = F.col(*DATE_KEY).isin(doubtful)
    together = merge.latest_per_key(rows.where(apart), FACT_KEYS[table], SEQUENCE)
    if len(doubtful) == len({p for x in snapshot.loads for p in x.parts}):
        return together
    return rows.where(~apart).unionByName(together)


def certain_since(snapshot: Snapshot, n: int) -> int:
    """The first of the newest days that together surely hold ``n`` merged rows.

    A day has at least the rows of its largest load, whatever its other loads replace, and all of
    them where no two loads overlap. No data are read. 0 if there are fewer rows.
    """
    doubtful = set(overlapping_partitions(snapshot))
    rows: dict[str, list[int]] = {}
    for load in snapshot.loads:
        for partition, (count, _, _) in load.parts.items():
            rows.setdefault(partition, []).append(count)
    held = 0
    for partition in sorted(rows, key=lambda p: -int(p.partition("=")[2])):
        held += max(rows[partition]) if partition in doubtful else sum(rows[partition])
        if held >= n:
            return int(partition.partition("=")[2])
    return 0


def table_figures(lake: Lake, table: str) -> dict[str, int | None]:
    """The table's figures (see ``figures``) over the rows that count; empty without loads.

    Observed figures of loads are summed; rows are read only of loads with days that overlap, of
    which some days no longer count, or that were written before a figure was asked for.
    """

    columns = figures.asked(table)

    def apart(now: Snapshot) -> list[str]:
        doubtful = set(overlapping_partitions(now)) if table in FACT_KEYS else set()
        return [x.attempt for x in now.loads if doubtful & set(x.parts) or not x.is_whole() or set(columns) - set(x.observed)]

    snapshot = lake.snapshot(table)
    parts = []
    if apart(snapshot):
        snapshot, rows = consistent(lake, table)
        rows = visible(snapshot, rows).where(F.col(ATTEMPT).isin(apart(snapshot)))
        rows = merged(snapshot, table, rows) if table in FACT_KEYS else rows
        found = rows.agg(*[c.alias(f"f{i}") for i, c in enumerate(columns.values())]).first()
        parts.append(dict(zip(columns, found, strict=True)))
    left = set(apart(snapshot))
    return figures.summed([*parts, *(x.observed for x in snapshot.loads if x.attempt not in left)])


# --- loads ----------------------------------------------------------------------


def sequence(lake: Lake, table: str, load: str) -> int:
    """The load's place in the order of loads: by first appearance of what stands before its
    last dot (a stream's id), then by the number after it (its batch)."""
    source, batch = snapshots.split_load(load)

    def add(now: Snapshot) -> Snapshot | None:
        if source in now.sources:
            return None
        return replace(now, sources={**now.sources, source: max(now.sources.values(), default=0) + 1})

    return (snapshots.commit(lake.spark, lake.versions(table), add).sources[source] << 32) + batch


def _new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"  # never a number


def _partition_of(by: list[str], key: tuple) -> str:
    return "/".join(f"{k}={NO_VALUE if v is None else v}" for k, v in zip(by, key, strict=True))


def _measured(rows: DataFrame, table: str, levels: tuple[str, ...]) -> tuple[list, dict[str, list]]:
    """Rows per folder, and per time partition its rows and range of keys."""
    by = [*partitions(table), *levels]
    at = F.unix_micros(F.col(RANGE_KEY).cast("timestamp")) if table in FACT_KEYS else F.lit(None).cast("long")
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)), F.min(at), F.max(at)).collect()
    parts: dict[str, list] = {}
    for row in counted:
        name, (n, low, high) = _partition_of(partitions(table), row[: len(partitions(table))]), row[len(by) :]
        known = parts.get(name, [0, low, high])
        lows, highs = ([v for v in pair if v is not None] for pair in ((known[1], low), (known[2], high)))
        parts[name] = [known[0] + n, min(lows, default=None), max(highs, default=None)]
    return [(tuple(row[: len(by)]), row[len(by)]) for row in counted], parts


def _written_schema(now: Snapshot, rows: DataFrame) -> str:
    """The columns of the table: those known and those of a new load."""
    fields = list(T.StructType.fromJson(json.loads(now.schema)).fields) if now.schema else []
    known = {f.name for f in fields}
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*fields, *[f for f in rows.schema.fields if f.name not in known]]]).json()


def write_load(
    lake: Lake, table: str, rows: DataFrame, load: str, *levels: str, gather: bool = False,
    few: int | None = None, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Adds one load and returns its rows; the same ``load`` again takes its own place, and is
    left out where compaction has replaced it.

    The rows are counted per folder first, so persist them if they are dear. ``gather`` deals
    them out to few files by those counts; without it no row moves. ``few`` is given for rows
    that are not persisted: up to so many folders they are left where they lie. ``finish`` adds columns that
    follow from a row alone, after the rows have moved.
    """
    by = [*partitions(table), *levels]
    counted, parts = _measured(rows, table, levels)
    attempt = _new_attempt()
    dealt = packing.packed(rows, by, counted, packing.FILE_BYTES, few is None) if gather and len(counted) > (few or 0) else rows
    marked = finish(dealt).withColumn(LOAD, F.lit(load))
    schema = marked.withColumn(ATTEMPT, F.lit(attempt))
    observed: dict[str, int | None] = {}
    if parts:
        seen_rows, seen, names = figures.watched(marked, table)
        (
            seen_rows.write.mode("append")
            # Tasks may put files in place as they end: none counts before its version.
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .partitionBy(*by, LOAD)
            .parquet(attempt_folder(lake, table, attempt))
        )
        observed = figures.of(seen, names)
        counts = sum(n for n, _, _ in parts.values())
        if observed[figures.ROWS] != counts:
            _remove_folder(lake, attempt_folder(lake, table, attempt))
            raise RuntimeError(f"load {load} of {table}: counted {counts} rows, then wrote {observed[figures.ROWS]}; nothing was published")

    def add(now: Snapshot) -> Snapshot | None:
        # Letters of one failure are in one day, but a retry may fail on another.
        elsewhere = now.replaced if table.startswith(QUARANTINE) else ()
        fresh = {p: v for p, v in parts.items() if not any(snapshots.is_replaced(now, x, load) for x in (p, *elsewhere))}
        earlier = [x for x in now.loads if x.load == load]
        if not parts and not earlier:
            return None
        left_out = [[p, load, attempt] for p in parts if p not in fresh]
        superseded = [[p, load, x.attempt] for x in earlier for p in x.parts]
        loads = [x for x in now.loads if x.load != load]
        if fresh:
            loads.append(Load(load, attempt, fresh, observed=observed))
        return replace(now, schema=_written_schema(now, schema), loads=loads, retired=[*now.retired, *left_out, *superseded])

    snapshots.commit(lake.spark, lake.versions(table), add)
    return sum(n for n, _, _ in parts.values())


# --- compaction -----------------------------------------------------------------


def _folders(lake: Lake, table: str, partition: str, load: str, attempt: str = "*") -> list:
    """The folders of a load's attempt in one partition, below further levels (city) as well."""
    found = []
    for below in ("", "*/"):
        pattern = lake.spark._jvm.org.apache.hadoop.fs.Path(f"{attempt_folder(lake, table, attempt)}/{partition}/{below}{LOAD}={load}")
        store = pattern.getFileSystem(lake.spark._jsc.hadoopConfiguration())
        found += [(store, status.getPath()) for status in store.globStatus(pattern) or []]
    return found


def _remove_loads(lake: Lake, table: str, partition: str, attempts: list[tuple[str, str]]) -> None:
    for load, attempt in attempts:
        for store, folder in _folders(lake, table, partition, load, attempt):
            store.delete(folder, True)
        if load.startswith(COMPACTED):  # such an attempt has one partition
            _remove_folder(lake, ranges_folder(lake, table, attempt))


def _remove_folder(lake: Lake, folder: str) -> None:
    path = lake.spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(lake.spark._jsc.hadoopConfiguration()).delete(path, True)


def _stored_bytes(lake: Lake, table: str, partition: str, loads: list[Load]) -> int:
    folders = [f for x in loads for f in _folders(lake, table, partition, x.load, x.attempt)]
    return sum(store.getContentSummary(folder).getLength() for store, folder in folders)


def _record(lake: Lake, table: str, partition: str, new: Load, replaces: list[Load]) -> None:
    """Publishes that the new load stands for the others in the partition."""
    gone = {x.attempt for x in replaces}

    def swap(now: Snapshot) -> Snapshot:
        if gone - {x.attempt for x in now.in_partition(partition)}:
            raise RuntimeError(f"loads of {partition} were delivered again while they were compacted; left as they are")
        loads = []
        for x in now.loads:
            parts = {p: v for p, v in x.parts.items() if x.attempt not in gone or p != partition}
            loads += [replace(x, parts=parts)] if parts else []
        names = [x.load for x in replaces if not x.load.startswith(COMPACTED)]
        return replace(
            now, loads=[*loads, new], replaced=snapshots.with_replaced(now, partition, names),
            retired=[*now.retired, *[[partition, x.load, x.attempt] for x in replaces]],
        )

    snapshots.commit(lake.spark, lake.versions(table), swap)


def clean_up(lake: Lake, table: str, keep_seconds: float = 0) -> None:
    """Removes what published versions retired, unless the newest version is too young."""
    now = lake.snapshot(table)
    if not now.retired:
        return
    name = f"{lake.versions(table)}/{snapshots._name(now.version)}"
    path = lake.spark._jvm.org.apache.hadoop.fs.Path(name)
    age = time.time() - path.getFileSystem(lake.spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime() / 1000
    if age < keep_seconds:
        return
    by_partition: dict[str, list[tuple[str, str]]] = {}
    for partition, load, attempt in now.retired:
        by_partition.setdefault(partition, []).append((load, attempt))
    for partition, attempts in by_partition.items():
        _remove_loads(lake, table, partition, attempts)
    live = {x.attempt for x in now.loads}
    for attempt in {a for _, _, a in now.retired} - live:  # what is left of it: empty folders
        _remove_folder(lake, attempt_folder(lake, table, attempt))
    done = set(map(tuple, now.retired))

    def forget(newest: Snapshot) -> Snapshot:
        return replace(newest, retired=[r for r in newest.retired if tuple(r) not in done])

    snapshots.commit(lake.spark, lake.versions(table), forget)


def compact(lake: Lake, table: str, day: dict[str, int], files: int | None = None, keep_seconds: float = 0) -> tuple[str, str, int]:
    """Makes one load of a day's loads; returns (table, outcome, rows).

    ``files`` is the number of write tasks; None sizes the files by bytes, by adaptive execution
    or, where the table has a layout, from the bytes that are stored. A day without rows is skipped and says so; one that is a single compacted load
    already is left as it is. One compaction of a table runs at a time.
    """
    clean_up(lake, table, keep_seconds)
    values = {"date_key": day["year"] * 10000 + day["month"] * 100 + day["day"], **day}
    partition = "/".join(f"{k}={values[k]}" for k in partitions(table))
    snapshot = lake.snapshot(table)
    loads = snapshot.in_partition(partition)
    if not loads:
        return table, "missing", 0
    # Copies that an earlier run wrote but did not publish count nowhere and go.
    live = {x.attempt for x in loads} | {a for p, _, a in snapshot.retired if p == partition}
    folders = [f for _, f in _folders(lake, table, partition, COMPACTED + "*")]
    copies = [(f.getName().partition("=")[2], re.search(rf"/{ATTEMPT}=(\w+)/", f.toString())[1]) for f in folders]
    _remove_loads(lake, table, partition, [c for c in copies if c[1] not in live])
    _, rows = consistent(lake, table)
    part = rows.where(_in_partition(partition) & F.col(ATTEMPT).isin([x.attempt for x in loads]))
    if table in FACT_KEYS and partition in overlapping_partitions(replace(snapshot, loads=loads)):
        part = merge.latest_per_key(part, FACT_KEYS[table], SEQUENCE)
    expected = part.count()
    if loads[1:] or not loads[0].load.startswith(COMPACTED):
        load, attempt = COMPACTED + uuid.uuid4().hex, _new_attempt()
        levels = [*partitions(table), *(c for c in ("city",) if c in part.columns), LOAD]
        new, plan = part.drop(ATTEMPT).withColumn(LOAD, F.lit(load)), layout.LAYOUTS.get(table)
        if plan:
            files = files or layout.file_count(_stored_bytes(lake, table, partition, loads))
            new = layout.clustered(new, plan, files, levels, FACT_KEYS[table])
        else:
            new = (new.hint("rebalance") if files is None else new.repartition(files)).sortWithinPartitions(*levels)
        new, seen, names = figures.watched(new, table)
        new.write.options(**(plan.options() if plan else {})).partitionBy(*levels).parquet(attempt_folder(lake, table, attempt))
        copied = stored_rows(lake, table, snapshot.schema, [attempt_folder(lake, table, attempt)])
        if plan:
            layout.file_ranges(copied, plan, attempt).coalesce(1).write.parquet(ranges_folder(lake, table, attempt))
        _, parts = _measured(copied, table, ())
        if parts[partition][0] != expected:
            _remove_loads(lake, table, partition, [(load, attempt)])
            raise RuntimeError(f"copied {parts[partition][0]} of {expected} rows of {partition}; table left as it was")
        _record(lake, table, partition, Load(load, attempt, parts, plan is not None, figures.of(seen, names)), loads)
        clean_up(lake, table, keep_seconds)
    return table, "compacted", expected
