"""From raw documents to sharded training text, in stages that each write their result.

All stages take nulls in any column, empty and very long texts, ties, repeated rows, empty tables
and further columns of any name; each operator states what it makes of them. Further columns go
through to the end. The last stage adds `size`, `shard` and `slot`; where the documents have a
column of that name, underscores are added to the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlake.llm import contamination, mixing, neardup, outliers, sharding
from roadlake.llm.tables import free_name, prepared, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the hard rules or are outliers in their language and source go."""
    prepared(spark)
    return outliers.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest id."""
    return neardup.keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    return contamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the mix takes them."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    prefix = "out_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    placed = sharding.shard_documents(docs, prefix=prefix)
    return placed.withColumnsRenamed({prefix + name: free_name(docs, name) for name in ("size", "shard", "slot")})


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# Fitted scatters, minwise trees and refined probes have no SQL form; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
