"""Record contract: what fits goes on, what does not is set aside with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.sources import wire


def violation(required: list[str], marked: bool = True, record: str = "record") -> Column:
    """Reason a parsed record breaks the contract, NULL when it does not.

    ``marked`` tells whether the parser leaves a corrupt-record field.
    """
    missing = F.array_compact(F.array(*[F.when(F.col(f"{record}.{n}").isNull(), F.lit(n)) for n in required]))
    unparsed = F.col(record).isNull()
    if marked:
        unparsed = unparsed | F.col(f"{record}.{wire.CORRUPT}").isNotNull()
    return (
        F.when(unparsed, F.lit("malformed record"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))
    )


def check_records(
    messages: DataFrame, text: Column, schema: T.StructType, required: list[str],
    zero_defaults: list[str] = (), record: Column | None = None,
) -> DataFrame:
    """Adds the parsed ``record`` and its ``reason`` (NULL when it fits) to each message.

    ``text`` is JSON, unless ``record`` gives another way to the record struct; it is
    then only what a rejected message is kept as.

    The record comes out of a one-element explode: a filter on the reason cannot be
    pushed below it, where it would parse the text again for every field it looks at.
    """
    texts = messages.withColumn("record_text", text)
    marked = record is None
    made = wire.parse_json(F.col("record_text"), schema) if marked else record
    parsed = texts.withColumn("record", F.explode(F.array(made)))
    needed = [n for n in required if n not in zero_defaults]
    checked = parsed.withColumn("reason", violation(needed, marked))
    filled = F.col("record")
    for name in zero_defaults:
        filled = filled.withField(name, F.coalesce(F.col(f"record.{name}"), F.lit(0)))
    return checked.withColumn("record", filled) if zero_defaults else checked


def accepted(checked: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    return checked.where("reason IS NULL").select(*[f"record.{n}" for n in schema.names], *keep)


def rejected(checked: DataFrame, *keep: str) -> DataFrame:
    """Dead-letter rows: when it failed, why, and the original record text."""
    return checked.where("reason IS NOT NULL").select(
        F.current_timestamp().alias("failed_at"), "reason", F.col("record_text").alias("record"), *keep
    )


def by_source(dead_letters: DataFrame, source: str) -> DataFrame:
    """The same dead letters as (ts, source, error, payload), for one mixed table of all sources."""
    return dead_letters.select(
        F.col("failed_at").alias("ts"), F.lit(source).alias("source"), F.col("reason").alias("error"),
        F.col("record").alias("payload"),
    )
