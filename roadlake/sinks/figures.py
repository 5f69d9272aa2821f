"""Figures of a load, observed while it is written.

Every write counts its rows and, in the same pass, what the table's checks and reports ask of single
rows. The figures go into the version with the load, so a check of a table sums figures of loads
and reads only rows whose load does not count whole: where loads overlap, or where only some of
a load's days are left. The rows written must be those counted before, or nothing is published.

Names that begin with `first_` or `last_` are least and greatest values; all others are counts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadlake.operators import quality

ROWS = "rows"
INGESTED = {"first_ingested_at": F.min, "last_ingested_at": F.max}
REPORTS: dict[str, dict[str, str]] = {
    "landing/flow": {"closed_rows": "road_closed"},
    "landing/incidents": {"placed_rows": "lat is not null and lon is not null"},
}


def asked(table: str) -> dict[str, Column]:
    """Aggregates over the rows of a table."""
    found = {ROWS: F.count(F.lit(1))}
    found |= {name: F.count_if(F.expr(condition)) for name, condition in REPORTS.get(table, {}).items()}
    if table in REPORTS:
        found |= {name: end("ingested_at") for name, end in INGESTED.items()}
    if table.startswith("facts/"):
        found |= {rule: F.count_if(bad) for rule, bad in quality.row_checks(table.rsplit("/", 1)[-1]).items()}
    return found


def known(rows: DataFrame, table: str) -> dict[str, Column]:
    """Those whose columns the rows have (all, unless a caller's table is its own)."""
    try:
        rows.select(*[c.alias(f"f{i}") for i, c in enumerate(asked(table).values())]).schema  # noqa: B018
    except Exception as error:
        if "UNRESOLVED_COLUMN" not in str(error):
            raise
        return {ROWS: F.count(F.lit(1))}
    return asked(table)


def watched(rows: DataFrame, table: str) -> tuple[DataFrame, Observation, list[str]]:
    columns = known(rows, table)
    seen = Observation()
    # The names of rules hold brackets; they are numbered on the way.
    return rows.observe(seen, *[c.alias(f"f{i}") for i, c in enumerate(columns.values())]), seen, list(columns)


def of(seen: Observation, names: list[str]) -> dict[str, int | None]:
    found = seen.get
    return {name: found[f"f{i}"] for i, name in enumerate(names)}


def summed(parts: Iterable[dict[str, int | None]]) -> dict[str, int | None]:
    """Figures of all rows together."""
    out: dict[str, int | None] = {}
    for part in parts:
        for name, value in part.items():
            pair = [v for v in (out.get(name), value) if v is not None]
            if name in INGESTED:
                out[name] = (min if name.startswith("first_") else max)(pair, default=None)
            else:
                out[name] = sum(pair)
    return out
