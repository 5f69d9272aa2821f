"""Merkle manifest of a document table by slot pivots.

Leaves are hashed from the fields of their rows and numbered, without gaps, within their
language by one range exchange. Each level of a tree is one aggregation: a parent's children
are spread by slot into FANOUT columns, their concatenation is hashed to the parent, and the
same columns without a child's own are its siblings. The top nodes of the languages are the
leaves of one more tree, built the same way, whose top is the root. Siblings then run down
level by level, so a row meets its own parent only, and proofs are folded per row.

No level is read into the driver or one task: a language with a third of all rows is many
ranges, and a parent has at most FANOUT children. Level k moves 1 / FANOUT^k of the rows.

Defined results: a null field hashes as "-"; a null language is a language of its own, the
first; null ids come first and are never tampered with; rows with one id are ordered by leaf,
so repeated rows have equal leaves side by side; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from roadlake.llm.tables import column, stored

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_ONE_IN = 3
_STEPS = "array<struct<left:string,right:string>>"
_LOCAL = (1 << 33) - 1  # monotonically_increasing_id keeps the place within a partition in 33 bits


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return digest(F.concat(*[encoded(fields[name]) for name in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and the leaf of the row as it is found later (some are tampered with)."""
    fields = {name: column(name) for name in FIELDS}
    lowered = F.translate(fields["text"], string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(fields["doc_id"].cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    hashed = leaf_hash(fields)
    return docs.select(
        fields["doc_id"].alias("doc_id"), fields["lang"].cast("string").alias("lang"), hashed.alias("leaf"),
        F.when(tampered, leaf_hash({**fields, "text": lowered})).otherwise(hashed).alias("found_leaf"),
    )


def numbered(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """The rows with `place`, gapless from 0 in the given order: ranges are sorted apart, and
    what comes before a range is a sum over the counts of the ranges (one row each)."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, purpose)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per range, so its size follows the number of partitions, not the rows.
    placed = ranged.join(F.broadcast(starts), part == F.col("_part"))
    place = F.col("_start") + F.col("_at").bitwiseAND(_LOCAL)
    return placed.withColumn("place", place).drop("_part", "_start", "_at")


def pivot(nodes: DataFrame) -> DataFrame:
    """One row per parent: its children's hashes in the columns s0 to s7, and its own hash.

    nodes: tree, idx (gapless from 0 in a tree), nodes (of the tree at this level), hash.
    """
    slot = F.col("idx") % FANOUT
    parents = nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).cast("bigint").alias("idx")).agg(
        F.max(F.ceil(F.col("nodes") / FANOUT).cast("bigint")).alias("nodes"),
        *[F.max(F.when(slot == i, F.col("hash"))).alias(f"s{i}") for i in range(FANOUT)],
    )
    return parents.withColumn("hash", digest(F.concat_ws("", *[F.col(f"s{i}") for i in range(FANOUT)])))


def siblings(slot: Column) -> Column:
    """What stands left and right of a slot among its parent's children."""
    side = lambda apart: F.concat_ws("", *[F.when(apart(F.lit(i)), F.col(f"s{i}")) for i in range(FANOUT)])
    return F.struct(side(lambda i: i < slot).alias("left"), side(lambda i: i > slot).alias("right"))


def grow(nodes: DataFrame, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted levels of all trees from their leaves up, and the top node of each tree."""
    levels = []
    tops = [nodes.where("nodes = 1")]
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        levels.append(stored(pivot(nodes.where("nodes > 1")), f"{purpose}-{len(levels) + 1}"))
        nodes = levels[-1].select("tree", "idx", "nodes", "hash")
        tops.append(nodes.where("nodes = 1"))
        most = -(-most // FANOUT)
    return levels, reduce(DataFrame.unionByName, [t.select("tree", "hash") for t in tops])


def paths(nodes: DataFrame, levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes with `steps`: the siblings on the way up, from the node's own run to the top.

    above: per tree, the steps that follow its top.
    """
    top = lambda rows: rows.where("nodes = 1").drop("steps").join(above, "tree")
    found = None
    for level in reversed(levels):
        below = top(level)
        if found is not None:
            below = below.unionByName(level.where("nodes > 1").join(found, ["tree", "idx"]))
        slots = F.array(*[
            F.when(F.col(f"s{i}").isNotNull(), F.struct(F.lit(i).alias("slot"), siblings(F.lit(i)).alias("step")))
            for i in range(FANOUT)
        ])
        children = below.select("tree", "idx", "steps", F.explode(F.filter(slots, lambda s: s.isNotNull())).alias("s"))
        if level is levels[0]:
            break
        found = children.select(
            "tree", (F.col("idx") * FANOUT + F.col("s.slot")).alias("idx"),
            F.concat(F.array("s.step"), F.col("steps")).alias("steps"),
        )
    alone = top(nodes)
    if not levels:
        return alone
    # Leaves meet their parent's columns: the widest rows are made last and never shuffled.
    parent = below.select(
        "tree", F.col("idx").alias("_parent"), F.col("steps").alias("_above"), *[f"s{i}" for i in range(FANOUT)]
    )
    rows = nodes.where("nodes > 1").withColumn("_parent", F.floor(F.col("idx") / FANOUT).cast("bigint"))
    joined = rows.join(parent, ["tree", "_parent"])
    steps = F.concat(F.array(siblings(F.col("idx") % FANOUT)), F.col("_above"))
    return joined.withColumn("steps", steps).select(*nodes.columns, "steps").unionByName(alone.select(*nodes.columns, "steps"))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof(steps: Column) -> Column:
    """All siblings from the leaf's run up to the root, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, found_leaf, subroot, root, and the steps of the leaf's proof."""
    rows = numbered(stored(leaves(docs), "merkle-leaves"), ["lang", "doc_id", "leaf"], "merkle-order")
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("nodes"), F.min("place").alias("first"))
    langs = stored(numbered(langs, ["lang"], "merkle-langs").withColumnRenamed("place", "tree"), "merkle-trees")
    keyed = rows.alias("r").join(langs.alias("l"), F.col("r.lang").eqNullSafe(F.col("l.lang"))).select(
        "tree", (F.col("place") - F.col("first")).alias("idx"), "nodes", F.col("leaf").alias("hash"), "doc_id", "found_leaf"
    )
    keyed = stored(keyed, "merkle-nodes")
    levels, tops = grow(keyed.select("tree", "idx", "nodes", "hash"), "merkle-level")

    # The languages' tops are the leaves of the last tree.
    count = langs.count()
    last = stored(tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("bigint").alias("nodes"), "hash"), "merkle-tops")
    last_levels, root = grow(last, "merkle-top")
    nothing = root.select("tree", F.lit(None).cast(_STEPS).alias("steps")).withColumn("steps", F.array().cast(_STEPS))
    above = paths(last, last_levels, nothing).select(F.col("idx").alias("tree"), F.col("hash").alias("subroot"), "steps")
    above = stored(above, "merkle-above")
    found = paths(keyed, levels, above.select("tree", "steps")).join(above.select("tree", "subroot"), "tree")
    top = root.first()
    return found.withColumn("root", F.lit(top["hash"] if top else None).cast(T.StringType())).withColumnRenamed("hash", "leaf")


def verify_documents(docs: DataFrame) -> DataFrame:
    """Every row's place in the manifest, and whether the row as found later still folds to the root."""
    folded = fold(F.col("found_leaf"), F.col("steps"))
    return manifest(docs).select(
        "doc_id", "leaf", "subroot", "root", digest(proof(F.col("steps"))).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

