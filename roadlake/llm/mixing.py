"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources share the words of all documents by weight; a target stops at `limit` times the
source's size and what it cannot take is shared again by weight among the others. The
targets are filled with blocks of `BLOCK` words: sources get block quotas by highest
quotients (divisors 1, 3, 5, ...), each source's quota is apportioned the same way to its
shards, and each shard takes its blocks from its documents in a seeded order: whole rounds
first, then the first blocks of one more round.

No shard takes more than `limit` times its words. What that cuts off, and what whole blocks
leave over or take too much, goes to (or comes from) the source's shards in the order of their next
quotients, word by word. So a source takes its target to the word, and one that stops at its
limit takes every document exactly `limit` times, however small it is.

Only DataFrame functions are used. A shard is a hash of the document id, and a source has about
sqrt(its words) / 16 of them, so neither a source with a third of all rows nor the list of
its shards is ever one task's work. Apportionment needs no list of all seats: rounding at the
mean quotient gives all but a few, and the rest are ranked among the next quotients only.

Defined results: null text has size 0 and is never taken; a null source is the last source; a
null id hashes like an empty one; repeated rows are separate documents; all sizes 0 or no
rows: nothing is taken; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.llm.tables import column, free_name, stored

BLOCK = 128
LIMIT = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, seeded order."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        _order(F.col("doc_id"), seed).alias("place"),
    )


def targets(sized: DataFrame, limit: int = LIMIT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """rank (of the source by name), source, source_size, total, target."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(limit * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    rank = F.row_number().over(by_name) - 1
    ranked = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", rank.cast("bigint"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(limit * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(onward))
        .withColumn("full", limit * F.col("source_size") * F.col("shares") < F.col("left") * F.col("weight"))
    )
    # The first source that is not full fixes the words per weight for itself and all after it.
    rate = F.max(F.when(~F.col("full"), F.col("left") / F.col("shares"))).over(everything)
    target = F.when(F.col("full"), (limit * F.col("source_size")).cast("double")).otherwise(rate * F.col("weight"))
    return ranked.select("rank", "source", "source_size", "total", target.alias("target"))


def apportion(rows: DataFrame, seats: str, share: str, group: list[str], key: list[Column], out: str) -> DataFrame:
    """Adds each row's seats when its group's seats go to the highest quotients share / (2k - 1)."""
    whole = Window.partitionBy(*group)
    rows = (
        rows.withColumn("_all", F.sum(share).over(whole))
        .withColumn("_n", F.count(F.lit(1)).over(whole))
        .withColumn("_fair", F.when(F.col("_all") > 0, F.col(share) / F.col("_all")).otherwise(0.0))
        .withColumn("_base", F.floor(F.col("_fair") * F.col(seats) + 0.5))
        .withColumn("_open", F.col(seats) - F.sum("_base").over(whole))
    )
    # Beyond the base, a row's seats change by at most its share of 1.5 n, and one.
    reach = (F.ceil(F.col("_fair") * 1.5 * F.col("_n")) + 1).cast("int")
    step = F.explode(F.sequence(F.lit(1), reach))
    steps = rows.where((F.col("_open") != 0) & (F.col(share) > 0)).select("*", step.alias("_j"))
    up = F.col("_open") > 0
    divisor = F.when(up, 2 * (F.col("_base") + F.col("_j")) - 1).otherwise(2 * (F.col("_base") - F.col("_j")) + 1)
    ranked = steps.where(up | (F.col("_j") <= F.col("_base"))).withColumn("_q", F.when(up, -1).otherwise(1) * F.col(share) / divisor)
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy("_q", *key, "_j")))
    names = [c for c in rows.columns if not c.startswith("_")]
    changed = ranked.where(F.col("_rank") <= F.abs("_open")).groupBy(*names, "_base", "_open").agg(F.count(F.lit(1)).alias("_d"))
    moved = changed.select(*names, (F.col("_base") + F.signum(F.col("_open")).cast("bigint") * F.col("_d")).alias(out), F.lit(1).alias("_p"))
    kept = rows.select(*names, F.col("_base").alias(out), F.lit(0).alias("_p"))
    return kept.unionByName(moved).groupBy(*names).agg(F.max_by(out, "_p").cast("bigint").alias(out))


def shard_of(place: Column, source_size: Column) -> Column:
    """About sqrt(words of the source) / 16 shards: they, and the documents of each, stay few."""
    shards = F.greatest(F.lit(1), F.ceil(F.sqrt(source_size.cast("double")) / 16)).cast("bigint")
    return F.conv(F.substring(place, 1, 8), 16, 10).cast("bigint") % shards


def aims_of(sized: DataFrame, limit: int, weights: tuple[int, ...], block: int) -> DataFrame:
    """rank, source, source_size, target, blocks: one row per source."""
    aims = targets(sized, limit, weights).withColumn("seats", F.floor(F.col("total") / block + 0.5).cast("bigint")).drop("total")
    return apportion(aims, "seats", "target", [], [F.col("rank")], "blocks").drop("seats")


def quotas(cells: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """rank, shard, cell, quota (words taken from the shard); cells has target and blocks as well."""
    seated = apportion(cells, "blocks", "cell", ["rank"], [F.col("shard")], "seats")
    source = Window.partitionBy("rank")
    order = source.orderBy((F.col("cell") / (2 * F.col("seats") + 1)).desc(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda name: F.coalesce(F.sum(name).over(order), F.lit(0))
    filled = seated.withColumn("whole", F.least(F.col("seats") * block, limit * F.col("cell")))
    filled = filled.withColumn("room", limit * F.col("cell") - F.col("whole"))
    left = F.floor(F.col("target") + 0.5).cast("bigint") - F.sum("whole").over(source)
    more = F.greatest(F.lit(0), F.least(F.col("room"), left - earlier("room")))
    less = F.greatest(F.lit(0), F.least(F.col("whole"), -left - earlier("whole")))
    return filled.select("rank", "shard", "cell", (F.col("whole") + F.when(left >= 0, more).otherwise(-less)).alias("quota"))


def mix(sized: DataFrame, limit: int = LIMIT, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """The sized rows (see `sizes`; other columns stay) with source_size, target and taken words."""
    narrow = sized.select("source", "size", "place")
    aims = stored(aims_of(narrow, limit, weights, block), "aims")

    def placed(rows: DataFrame, own: str) -> DataFrame:
        """With the rank of their source, its aims, and their shard."""
        aim = aims.select(F.col("rank").alias(own + "r"), F.col("source").alias(own + "s"), "source_size", "target", F.col("blocks").alias(own + "b"))
        joined = rows.join(aim, rows["source"].eqNullSafe(F.col(own + "s"))).drop(own + "s")
        return joined.withColumn(own + "h", shard_of(F.col("place"), F.col("source_size")))

    q = free_name(sized, "_quota")
    cells = placed(narrow, q).groupBy(F.col(q + "r").alias("rank"), F.col(q + "h").alias("shard")).agg(
        F.sum("size").alias("cell"), F.max("target").alias("target"), F.max(q + "b").alias("blocks")
    )
    plan = stored(quotas(cells, limit, block), "quotas").select(
        F.col("rank").alias(q + "r2"), F.col("shard").alias(q + "h2"), F.col("cell").alias(q + "c"), F.col("quota").alias(q)
    )
    rows = placed(sized, q)
    joined = rows.join(plan, (F.col(q + "r") == F.col(q + "r2")) & (F.col(q + "h") == F.col(q + "h2")))
    order = Window.partitionBy(q + "r", q + "h").orderBy("place", "doc_id", "size")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    cell = F.greatest(F.col(q + "c"), F.lit(1))
    rounds, rest = F.floor(F.col(q) / cell), F.col(q) % cell
    taken = F.col("size") * rounds + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return joined.withColumn("taken", taken.cast("bigint")).drop(q, *[q + x for x in ("r", "h", "b", "r2", "h2", "c")])


def mix_report(docs: DataFrame) -> DataFrame:
    mixed = mix(stored(sizes(docs), "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame) -> DataFrame:
    """Whole documents, repeated as often as the mix takes them (a last part of one rounds)."""
    sized = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"), "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), _order(F.col("doc_id"), SEED).alias("place"),
    )
    mixed = mix(sized)
    copies = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)) + 0.5).cast("int")
    return mixed.withColumn("copies", copies).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
