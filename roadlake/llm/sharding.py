"""Sharding by histogram sort.

Documents are ordered by (hash of the text, hash of the id). Splitters between shards are
found by counting: each round sums the exact bytes of every candidate interval (512 per
splitter that is still open, reduced on the map side) and refines only the interval that
holds the wanted byte count, until an edge lies within the tolerance. Then the rows are
exchanged once, to (shard, part); a part is a slice of id hashes, so a text with a third of
all rows is spread too. Slots are the offset of the part within its shard plus the place
within the part.

Equal texts are neighbours and stay together unless only a cut between them meets the
tolerance. Only candidate counts reach the driver: at most 512 per splitter.

Defined results: a null text counts 0 bytes; null ids hash as null; repeated rows are separate
documents and share a key; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.llm.tables import column, free_name, stored

SHARDS = 24
OVERHEAD = 8
TOLERANCE = 0.002  # of a shard's share
DIGIT = 9
KEY_BITS = 63
ROUNDS = KEY_BITS // DIGIT


def _hash(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - KEY_BITS)


def _digits(level: int) -> Column:
    """The key's digit of a round: first those of `hi`, then those of `lo`."""
    key, k = (F.col("hi"), level) if level < ROUNDS else (F.col("lo"), level - ROUNDS)
    return F.shiftright(key, KEY_BITS - DIGIT * (k + 1)).bitwiseAND((1 << DIGIT) - 1).cast("int")


def _prefix(level: int) -> Column:
    return F.concat_ws(".", *[_digits(k) for k in range(level)])


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """The shards - 1 keys (hi, lo) at which a new shard begins; keys has hi, lo and size."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = total / shards
    found: dict[int, tuple[int, ...]] = {}
    # Open splitters by the interval they lie in: digits of the interval, bytes below it.
    open_in: dict[tuple[int, ...], tuple[int, list[int]]] = {(): (0, list(range(1, shards)))} if total else {}
    for level in range(2 * ROUNDS):
        if not open_in:
            break
        rows = keys.select(_prefix(level).alias("prefix"), _digits(level).alias("digit"), "size")
        rows = rows.where(F.col("prefix").isin([".".join(map(str, p)) for p in open_in]))
        sums: dict[str, dict[int, int]] = {}
        for r in rows.groupBy("prefix", "digit").agg(F.sum("size").alias("size")).collect():
            sums.setdefault(r.prefix, {})[r.digit] = r["size"]
        deeper: dict[tuple[int, ...], tuple[int, list[int]]] = {}
        for p, (below, wanted) in open_in.items():
            counts = sums[".".join(map(str, p))]
            for j in wanted:
                goal, at = j * share, below
                for digit in sorted(counts):
                    if at + counts[digit] >= goal:
                        break
                    at += counts[digit]
                after = at + counts[digit]
                last = level == 2 * ROUNDS - 1
                if min(goal - at, after - goal) <= tolerance * share or last:
                    found[j] = (*p, digit + (after - goal < goal - at))
                else:
                    deeper.setdefault((*p, digit), (at, []))[1].append(j)
        open_in = deeper
    return [_key(found[j]) for j in sorted(found)]


def _key(digits: tuple[int, ...]) -> tuple[int, int]:
    value = 0
    for d in digits:  # a digit one past its range carries into the one before
        value = (value << DIGIT) + d
    value <<= DIGIT * (2 * ROUNDS - len(digits))
    return value >> KEY_BITS, value & ((1 << KEY_BITS) - 1)


def _shard(hi: Column, lo: Column, cuts: list[tuple[int, int]], first: int = 0) -> Column:
    """Number of cuts at or below the key, by bisection."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    high, low = cuts[middle]
    if high >= 1 << KEY_BITS:  # beyond every key
        return _shard(hi, lo, cuts[:middle], first)
    below = (hi < high) | ((hi == high) & (lo < low))
    return F.when(below, _shard(hi, lo, cuts[:middle], first)).otherwise(_shard(hi, lo, cuts[middle + 1 :], first + middle + 1))


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, prefix: str = "_") -> DataFrame:
    """The rows with size, shard and slot in columns of the given prefix."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + OVERHEAD
    hi, lo = _hash(F.col("text")), _hash(F.col("doc_id"), F.col("text"))
    keys = stored(docs.select(hi.alias("hi"), lo.alias("lo"), size.alias("size")), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    rows = keys.agg(F.count(F.lit(1))).first()[0]
    parts = max(1, int(rows**0.5) // 4)
    part = lambda low: F.shiftright(low, KEY_BITS - 31) % parts

    counts = keys.groupBy(_shard(F.col("hi"), F.col("lo"), cuts).alias("s"), part(F.col("lo")).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    own = free_name(docs, "_own")
    offsets = counts.select(
        F.col("s").alias(own + "s"), F.col("p").alias(own + "p"), (F.sum("n").over(before) - F.col("n")).alias(own + "offset")
    )
    keyed = docs.withColumns({own + "hi": hi, own + "lo": lo, f"{prefix}size": size})
    keyed = keyed.withColumn(f"{prefix}shard", _shard(F.col(own + "hi"), F.col(own + "lo"), cuts)).withColumn(own, part(F.col(own + "lo")))
    joined = keyed.join(offsets, (F.col(f"{prefix}shard") == F.col(own + "s")) & (F.col(own) == F.col(own + "p")))
    within = Window.partitionBy(own + "s", own + "p").orderBy(own + "hi", own + "lo")
    slot = F.col(own + "offset") + F.row_number().over(within) - 1
    return joined.withColumn(f"{prefix}slot", slot.cast("bigint")).select(
        *[column(c) for c in docs.columns], f"{prefix}size", f"{prefix}shard", f"{prefix}slot"
    )


def shard_report(docs: DataFrame) -> DataFrame:
    placed = shard_documents(docs.select("doc_id", "text"), prefix="out_")
    return placed.select(
        "doc_id", F.col("out_size").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("out_shard").cast("int").alias("shard"), F.col("out_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
