"""Which task writes which partition: few files per load, none too large.

Spark writes a file per task and folder. Partitions are dealt out to tasks by their counted rows,
first-fit decreasing, so each folder gets one file; a partition beyond the size of a file is
salted over several tasks. It is an explicit repartition, so it holds in micro-batches too,
where adaptive execution and its rebalance hint are off.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_BYTES = 128 << 20
TASKS_PER_CORE = 3  # equal rows are not equal time: a task with many folders writes many files
ROW_BYTES = (16, 1 << 16)  # bounds for what the plan's statistics say of a row


def first_fit(counts: list[int], tasks: int, most: int) -> list[tuple[int, int]]:
    """(first task, tasks) of each partition; no task gets more than `most` rows, and
    partitions share tasks only as far as `tasks` of them would be kept busy."""
    room = max(1, min(most, math.ceil(sum(counts) / max(1, tasks))))
    out, free = [(0, 1)] * len(counts), []  # rows that still fit, by task
    for i in sorted(range(len(counts)), key=lambda i: -counts[i]):
        pieces = max(1, math.ceil(counts[i] / most))
        if pieces > 1:
            out[i] = (len(free), pieces)
            free += [0] * pieces
            continue
        task = next((t for t, left in enumerate(free) if left >= counts[i]), None)
        if task is None:
            free.append(max(room, counts[i]))
            task = len(free) - 1
        free[task] -= counts[i]
        out[i] = (task, 1)
    return out


def rows_per_file(rows: DataFrame, total: int, file_bytes: int = FILE_BYTES, persisted: bool = True) -> int:
    """Rows of a file, from the size Spark knows of a persisted frame. Else from the columns' types:
    the size of a plan may be far off, that of a join is the product of its sides."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    width = int(plan.stats().sizeInBytes()) / max(1, total) if persisted else plan.schema().defaultSize()
    width = min(max(width, ROW_BYTES[0]), ROW_BYTES[1])
    return max(1, int(file_bytes / width))


def packed(rows: DataFrame, by: list[str], counted: list[tuple[tuple, int]], file_bytes: int = FILE_BYTES, persisted: bool = True) -> DataFrame:
    """The rows, dealt out to the tasks that write them. ``counted`` has the rows per partition."""
    if not counted:
        return rows
    counts = [n for _, n in counted]
    most = rows_per_file(rows, sum(counts), file_bytes, persisted)
    placed = first_fit(counts, rows.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE, most)
    tasks = max(first + pieces for first, pieces in placed)
    if tasks == 1:
        return rows.coalesce(1)
    names = [f"_by{i}" for i in range(len(by))]
    kinds = ", ".join(f"{n} {rows.schema[c].dataType.simpleString()}" for n, c in zip(names, by, strict=True))
    plan = [(*key, first, pieces) for (key, _), (first, pieces) in zip(counted, placed, strict=True)]
    # One row per partition of this load, made on the driver.
    deal = F.broadcast(rows.sparkSession.createDataFrame(plan, f"{kinds}, _first int, _pieces int"))
    same = [F.col(c).eqNullSafe(F.col(n)) for n, c in zip(names, by, strict=True)]
    salt = F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")).cast("int")
    dealt = rows.join(deal, same).withColumn("_task", F.col("_first") + salt)
    return dealt.repartitionById(tasks, "_task").select(*rows.columns)
