"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model has order `ORDER` over UTF-8 bytes, so it needs no vocabulary and no cap: its n-grams are
those of all trusted documents (label quality = 1), and grow with them. Counts are reduced in
each task, then sharded by n-gram; continuation counts, discounts and context weights follow
by aggregations, and interpolated probabilities by joins from order to order.

Documents are scored by sharded count joins. A chunk is one input split. It sends each n-gram
it holds once; the distinct n-grams of all chunks are joined with the orders of the model,
longest first, and only those not found go on, with the weight of their context. The answers
go back to the chunk, where they meet its texts again (compressed on the way), and
every byte's log probability is looked up and summed per document. So the shuffles carry
distinct n-grams and one copy of the text, never a row per n-gram and document.

A document is kept when its perplexity lies between the 1 % and 99 % quantiles of trusted
documents in its language, widened by `MARGIN` on both sides; a language without trusted
documents takes the quantiles of all languages.

Defined results: a null or empty text has no perplexity and is not kept; a null language is a
language of its own; repeated documents are scored each; without trusted text no perplexity
is known and every non-empty document is kept; an empty table gives no rows; other columns
are not read. `docs` should be a stored table: it is read twice and its splits name the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm.tables import sieve, stored
from roadlake.llm.textbytes import Slice, mix, slices

ORDER = 5
QUANTILES = (0.01, 0.99)
MARGIN = 1.35
SLICE = 1 << 20
_TABLE_BITS = 20


def grams_of(s: Slice) -> np.ndarray:
    """For every byte of the slice's texts, it and the ORDER - 1 bytes before it; zeros stand
    before a text's first byte."""
    lengths = np.diff(s.bounds)
    gap = (ORDER - 1) * np.arange(1, s.n + 1)
    at = np.arange(len(s.data)) + np.repeat(gap, lengths)
    padded = np.zeros(len(s.data) + (ORDER - 1) * s.n, np.uint64)
    padded[at] = s.data
    gram = np.zeros(len(at), np.uint64)
    for k in range(ORDER - 1, -1, -1):
        gram = (gram << np.uint64(8)) | padded[at - k]
    return gram


def _slot(gram: np.ndarray) -> np.ndarray:
    return (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class _Counter:
    """Distinct n-grams and their counts, merged as they come."""

    def __init__(self):
        self.grams, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, gram: np.ndarray) -> None:
        grams, counts = np.unique(gram, return_counts=True)
        self.waiting.append((grams, counts))
        self.held += len(grams)
        if self.held > max(1 << 21, len(self.grams)):
            self.merge()

    def merge(self) -> None:
        grams = np.concatenate([self.grams, *(g for g, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.grams, inverse = np.unique(grams, return_inverse=True)
        self.counts = np.bincount(inverse, weights=counts, minlength=len(self.grams)).astype(np.int64)
        self.waiting, self.held = [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = _Counter()
    for batch in batches:
        for s in slices(batch.column("text"), SLICE):
            counter.add(grams_of(s))
    counter.merge()
    for low in range(0, len(counter.grams), 100_000):
        part = slice(low, low + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(counter.grams[part].view(np.int64)), pa.array(counter.counts[part])], names=["g", "c"]
        )


def _mask(order: int) -> int:
    return (1 << (8 * order)) - 1


def train(trusted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1 to ORDER: (g, p) of the seen n-grams and (h, weight) of the seen contexts."""
    counted = trusted.select("text").mapInArrow(_count, "g long, c long")
    counts = {ORDER: stored(counted.groupBy("g").agg(F.sum("c").alias("c")), "counts")}
    for k in range(ORDER - 1, 0, -1):
        below = counts[k + 1].groupBy(F.col("g").bitwiseAND(_mask(k)).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        counts[k] = stored(below, "counts")
    model: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        n = [r or 0 for r in counts[k].agg(*[F.count(F.when(F.col("c") == i, 1)) for i in range(1, 5)]).first()]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
        cut = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.5 * (i + 1), 0.05), i + 0.95) for i in range(3)]
        c = F.col("c")
        discount = F.when(c == 1, cut[0]).when(c == 2, cut[1]).otherwise(cut[2])
        context = F.shiftright("g", 8)
        rows = counts[k].select("g", "c", context.alias("h"), discount.alias("d"))
        contexts = rows.groupBy("h").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"))
        contexts = stored(contexts, "contexts")
        joined = rows.join(contexts, "h")
        if k == 1:
            lower = joined.withColumn("below", F.lit(1 / 256))
        else:
            suffix = model[-1][0].select(F.col("g").alias("s"), F.col("p").alias("below"))
            lower = joined.join(suffix, F.col("g").bitwiseAND(_mask(k - 1)) == F.col("s"))
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * F.col("below")
        model.append((stored(lower.select("g", p.alias("p")), "probabilities"), contexts.select("h", "weight")))
    return model


def look_up(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(g, logp) of distinct n-grams of ORDER: the longest seen one, times the weights of the
    seen contexts above it."""
    found: list[DataFrame] = []
    pending = grams.select("g", F.col("g").alias("key"), F.lit(0.0).alias("w"))
    for k in range(ORDER, 0, -1):
        seen, contexts = model[k - 1]
        joined = pending.join(seen.select(F.col("g").alias("key"), "p"), "key", "left")
        joined = stored(joined.select("g", "key", "w", "p"), "found")
        found.append(joined.where("p is not null").select("g", (F.col("w") + F.log("p")).alias("logp")))
        above = joined.where("p is null").select("g", "key", "w", F.shiftright("key", 8).alias("h")).join(contexts, "h", "left")
        weight = F.coalesce(F.log("weight"), F.lit(0.0))
        pending = above.select("g", F.col("key").bitwiseAND(_mask(k - 1)).alias("key"), (F.col("w") + weight).alias("w"))
    rows = pending.select("g", (F.col("w") - F.log(F.lit(256.0))).alias("logp"))
    for part in found:
        rows = rows.unionByName(part)
    return rows


def _zip(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), "zstd", asbytes=True)


def _unzip(blob: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


_ASKED = "chunk long, shard long, n long, grams binary"
_ANSWER = "chunk long, n long, grams binary, logps binary"
_TEXTS = "chunk long, ids array<long>, langs array<string>, lengths array<long>, size long, data binary"
_SCORED = "doc_id long, lang string, n_bytes long, logp double"


def _ask(shards: int):
    """Each n-gram of the chunk once, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, new = None, [np.zeros(0, np.uint64)]
        recent = np.full(1 << _TABLE_BITS, np.iinfo(np.uint64).max, np.uint64)
        for batch in batches:
            chunk = batch.column("chunk")[0].as_py() if len(batch) else chunk
            for s in slices(batch.column("text"), SLICE):
                gram = grams_of(s)
                slot = _slot(gram)
                fresh = np.flatnonzero(recent[slot] != gram)
                recent[slot[fresh]] = gram[fresh]
                new.append(np.unique(gram[fresh]))
                if sum(map(len, new)) > 1 << 22:
                    new = [np.unique(np.concatenate(new))]
        grams = np.unique(np.concatenate(new))
        shard = (mix(grams) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = grams[order[cuts[b] : cuts[b + 1]]]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((chunk, pa.int64()), (b, pa.int64()), (len(part), pa.int64()), (_zip(part), pa.binary()))], names=[c.split()[0] for c in _ASKED.split(", ")])

    return run


def _asked(table: pa.Table) -> list[np.ndarray]:
    return [_unzip(g, n, np.uint64) for g, n in zip(table.column("grams").to_pylist(), table.column("n").to_pylist(), strict=True)]


def _distinct(table: pa.Table) -> pa.Table:
    return pa.table({"g": pa.array(np.unique(np.concatenate(_asked(table))).view(np.int64))})


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    gram, logp = known.column("g").to_numpy().view(np.uint64), known.column("logp").to_numpy().astype(np.float32)
    order = np.argsort(gram)
    gram, logp = gram[order], logp[order]
    parts = _asked(asked)
    return pa.table({
        "chunk": asked.column("chunk"), "n": asked.column("n"), "grams": asked.column("grams"),
        "logps": pa.array([_zip(logp[np.searchsorted(gram, part)]) for part in parts], pa.binary()),
    })


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in slices(batch.column("text"), SLICE):
            part = slice(s.first, s.first + s.n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("chunk")[s.first : s.first + 1],
                    pa.array([batch.column("doc_id").to_pylist()[part]], pa.list_(pa.int64())),
                    pa.array([batch.column("lang").to_pylist()[part]], pa.list_(pa.string())),
                    pa.array([np.diff(s.bounds).tolist()], pa.list_(pa.int64())),
                    pa.array([len(s.data)], pa.int64()),
                    pa.array([_zip(s.data)], pa.binary()),
                ],
                names=["chunk", "ids", "langs", "lengths", "size", "data"],
            )


def _score(texts: pa.Table, answers: pa.Table) -> pa.Table:
    grams = np.concatenate(_asked(answers)) if len(answers) else np.zeros(0, np.uint64)
    logps = [_unzip(b, n, np.float32) for b, n in zip(answers.column("logps").to_pylist(), answers.column("n").to_pylist(), strict=True)]
    logp = np.concatenate(logps) if logps else np.zeros(0, np.float32)
    order = np.argsort(grams)
    grams, logp = grams[order], logp[order]
    # The last n-gram of each slot answers most look-ups at once; the rest are searched.
    holder = np.zeros(1 << _TABLE_BITS, np.int64)
    holder[_slot(grams)] = np.arange(len(grams))
    ids, langs, lengths, sums = [], [], [], []
    for row in range(len(texts)):
        size = np.array(texts.column("lengths")[row].as_py(), np.int64)
        data = _unzip(texts.column("data")[row].as_py(), texts.column("size")[row].as_py(), np.uint8)
        gram = grams_of(Slice(0, data, np.concatenate([[0], np.cumsum(size)])))
        if len(gram):
            at = holder[_slot(gram)]
            other = np.flatnonzero(grams[at] != gram)
            at[other] = np.searchsorted(grams, gram[other])
            if (grams[np.minimum(at[other], len(grams) - 1)] != gram[other]).any():
                raise ValueError("the input splits changed between two reads: store the documents first")
            total = np.concatenate([[0.0], np.cumsum(logp[at], dtype=np.float64)])
        else:
            total = np.zeros(1)
        bounds = np.concatenate([[0], np.cumsum(size)])
        ids += texts.column("ids")[row].as_py()
        langs += texts.column("langs")[row].as_py()
        lengths.append(size)
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    none = np.zeros(0)
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()),
        "n_bytes": pa.array(np.concatenate(lengths or [none]).astype(np.int64)), "logp": pa.array(np.concatenate(sums or [none])),
    })


def log_probabilities(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """doc_id, lang, n_bytes and the sum of log probabilities of every document."""
    chunked = docs.select(F.spark_partition_id().cast("bigint").alias("chunk"), "text")
    texts = docs.select(
        F.spark_partition_id().cast("bigint").alias("chunk"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    )
    # As many shards as there are shuffle partitions, which follow the input.
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = stored(chunked.mapInArrow(_ask(shards), _ASKED), "asked")
    distinct = stored(asked.groupBy("shard").applyInArrow(_distinct, "g long"), "grams")
    known = stored(look_up(distinct, model), "logps")
    # The shard of an n-gram is computed where it was asked for.
    by_shard = known.mapInArrow(_to_shard(shards), "shard long, g long, logp double")
    answers = asked.groupBy("shard").cogroup(by_shard.groupBy("shard")).applyInArrow(_answer, _ANSWER)
    packed = texts.mapInArrow(_pack_texts, _TEXTS)
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score, _SCORED)


def _to_shard(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = (mix(batch.column("g").to_numpy().view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), batch.column("g"), batch.column("logp")], names=["shard", "g", "logp"])

    return run


def perplexity(logp: Column, n_bytes: Column) -> Column:
    return F.when(n_bytes > 0, F.exp(-logp / n_bytes))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_bytes, perplexity, low, high (the bounds of its language), kept."""
    trusted = stored(labels.where("doc_id is not null and quality = 1").select(F.col("doc_id").cast("bigint").alias("id")).distinct(), "trusted")
    doc_id = F.col("doc_id").cast("bigint")
    texts = docs.select(doc_id.alias("id"), "text").where(sieve(trusted, "id")(F.coalesce("id", F.lit(0)))).join(trusted, "id", "left_semi")
    if trusted.isEmpty() or texts.where(F.octet_length("text") > 0).isEmpty():
        none, size = F.lit(None).cast("double"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
        return docs.select("doc_id", size.alias("n_bytes"), none.alias("perplexity"), none.alias("low"), none.alias("high"), (size > 0).alias("kept"))
    rows = log_probabilities(docs, train(texts))
    rows = stored(rows.withColumn("perplexity", perplexity(F.col("logp"), F.col("n_bytes"))), "perplexities")
    good = rows.join(trusted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").where("perplexity is not null")
    bounds = F.percentile_approx("perplexity", F.array(*map(F.lit, QUANTILES)), 1000)
    overall = good.agg(bounds.alias("q")).first().q
    of_lang = stored(good.groupBy(F.col("lang").alias("of")).agg(bounds.alias("q")), "bounds")
    judged = rows.join(of_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    low = F.coalesce(F.col("q")[0], F.lit(overall[0])) / MARGIN
    high = F.coalesce(F.col("q")[1], F.lit(overall[1])) * MARGIN
    kept = F.coalesce(F.col("perplexity").between(low, high), F.lit(False))
    return judged.select("doc_id", "n_bytes", "perplexity", low.alias("low"), high.alias("high"), kept.alias("kept"))
