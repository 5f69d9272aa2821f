"""Named queries over the benchmark tables, each with the SQL that says what it should give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.catalog.sql import is_rounded
from roadlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(rows: DataFrame) -> DataFrame:
    """Floats as doubles; averages and ratios to 6 decimals, as summation order varies."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = column.cast("double")
            if is_rounded(field.name):
                column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
