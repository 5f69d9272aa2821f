"""One query per operator over the whole tables, in the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlake.llm import (
    alignment,
    chat,
    contamination,
    linktrust,
    merkle,
    merkle_sql,
    mixing,
    mixing_sql,
    neardup,
    outliers,
    perplexity,
    secrets,
    sharding,
    suffixdup,
    toxicity,
)
from roadlake.llm.tables import prepared, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepared(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


@query
def op6_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, hard rules and outlier verdict of every document."""
    return outliers.outlier_report(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = mixing_sql.OP8


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards near equal in bytes."""
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items found."""
    return contamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside 100-byte strings that also start earlier."""
    return suffixdup.repeat_report(table(spark, sf_dir, "documents"))


@query
def op3_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the prefix tree's stream."""
    return chat.chat_report(chat.with_hard_conversation(table(spark, sf_dir, "conversations")))


ORACLES["op3_chat_tree"] = chat.OP3


@query
def op7_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return linktrust.judge_pages(table(spark, sf_dir, "pages"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and whether it is kept."""
    return perplexity.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the Merkle manifest, and whether a later copy still verifies."""
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


ORACLES["op13_merkle"] = merkle_sql.OP13


@query
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns, and credential values that are costly to guess."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, shared groups and links of every document under two tokenizers."""
    return alignment.alignment_report(table(spark, sf_dir, "documents"))
