"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of whole texts (`SHARD_BYTES`, or one longer text). Its words become
symbols of the benchmark's vocabulary; every other word, and every text's end, is a
separator. Stretches of known words shorter than the shortest window cannot hold one and are
left out of the index. Over the rest stand a suffix array by prefix doubling, the
Burrows-Wheeler transform, a wavelet matrix for ranks and sampled suffix positions. All
windows of the benchmark are searched backwards at once, occurrences are located by walking
to a sampled position, and overlapping occurrences merge into removal spans.

The benchmark goes to the tasks in blocks of at most `BLOCK_BYTES` of text; each block is
searched in all texts and the spans of the blocks are merged.

Defined results: null or empty texts and items have no words and match nothing; repeated
items are searched once and each reported; repeated documents are reported each; an empty benchmark
or document table gives no hits or no rows; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from roadlake.llm.tables import column, free_name, stored
from roadlake.llm.textbytes import ALPHANUMERIC, hashes, slices, word_spans

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
SAMPLE = 8
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("words", T.ArrayType(SPAN)),  # merged spans, in word positions
        T.StructField("bytes", T.ArrayType(SPAN)),  # the same, in UTF-8 bytes of the text
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Patterns:
    """The benchmark's windows as symbols; which items hold each window."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = index + 1
    windows: np.ndarray  # one row each, symbols in reading order, zeros in front of short ones
    lengths: np.ndarray
    item_of: list[np.ndarray] = field(default_factory=list)  # items of each window
    item_ids: list[str] = field(default_factory=list)

    @staticmethod
    def of(item_ids: list[str], texts: list[str | None], window: int = WINDOW) -> Patterns:
        words: list[np.ndarray] = []
        for s in slices(pa.array(texts, pa.large_string()), lower=True):
            starts, ends, counts = word_spans(s, ALPHANUMERIC)
            words += np.split(hashes(s.prefix(), starts, ends), np.cumsum(counts)[:-1])
        vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        seen: dict[bytes, set[int]] = {}
        for item, hashed in enumerate(words):
            symbols = np.searchsorted(vocabulary, hashed) + 1
            for at in range(max(1, len(symbols) - window + 1) if len(symbols) else 0):
                row = np.zeros(window, np.int32)
                part = symbols[at : at + window]
                row[window - len(part) :] = part
                seen.setdefault(row.tobytes(), set()).add(item)
        windows = np.array([np.frombuffer(k, np.int32) for k in seen], np.int32).reshape(-1, window)
        return Patterns(vocabulary, windows, (windows > 0).sum(axis=1), [np.array(sorted(v)) for v in seen.values()], item_ids)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low, high = np.zeros(len(end), np.int64), end.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low


class FMIndex:
    """Full-text index of a sequence of symbols in which 0 separates stretches."""

    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = SAMPLE):
        n = len(sequence)
        # Each separator is a symbol of its own for sorting, so no suffix compares past one.
        separators = np.flatnonzero(sequence == 0)
        rank = sequence.astype(np.int64) + len(separators)
        rank[separators] = np.arange(len(separators))
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            keys = rank * (int(rank.max(initial=0)) + 2) + after
            order = np.argsort(keys, kind="stable")
            in_order = keys[order]
            fresh = np.zeros(n, np.int64)
            fresh[1:] = in_order[1:] != in_order[:-1]
            rank[order] = np.cumsum(fresh)
            if not n or rank[order[-1]] == n - 1 or width >= n:
                break
            width *= 2
        self.last = sequence[order - 1].astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.tree = WaveletMatrix(self.last, symbols)
        # A stretch starts where a separator stands before: the walk back ends there too.
        self.sampled = (order % sample == 0) | (self.last == 0)
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all windows at once: their suffix intervals."""
        width = windows.shape[1]
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.last), np.int64)
        for k in range(1, width + 1):
            live = np.flatnonzero((lengths >= k) & (low < high))
            if not len(live):
                break
            symbol = windows[live, width - k].astype(np.int64)
            low[live] = self.first[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Sequence position of each suffix row, by steps back to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            at = rows[walking]
            rows[walking] = self.first[self.last[at]] + self.tree.rank(self.last[at], at)
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.positions[self.slot[rows]] + steps


def _search_shard(s, patterns: Patterns):
    """Per text: words; all occurrences as (text, first word in shard, words, window)."""
    starts, ends, counts = word_spans(s, ALPHANUMERIC)
    none = np.zeros(0, np.int64)
    empty = (starts, ends, counts, none, none, none)
    if not len(starts) or not len(patterns.windows):
        return empty
    hashed = hashes(s.prefix(), starts, ends)
    at = np.searchsorted(patterns.vocabulary, hashed)
    at[at == len(patterns.vocabulary)] = 0
    symbols = np.where(patterns.vocabulary[at] == hashed, at + 1, 0).astype(np.int32)
    text = np.repeat(np.arange(s.n), counts)
    # Stretches of known words within one text, at least as long as the shortest window.
    known = symbols > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1] | (text[1:] != text[:-1])
    begin = np.flatnonzero(begins)
    stretch = np.cumsum(begins) - 1
    length = np.bincount(stretch[known], minlength=len(begin)) if len(begin) else none
    chosen = length >= patterns.lengths.min()
    if not chosen.any():
        return empty
    begin, length = begin[chosen], length[chosen]
    place = np.cumsum(length + 1) - length  # a separator before each stretch
    sequence = np.zeros(int(place[-1] + length[-1]), np.int32)
    word = np.zeros(len(sequence), np.int64)
    inside = np.repeat(place - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    word[inside] = np.repeat(begin - place, length) + inside
    sequence[inside] = symbols[word[inside]]

    index = FMIndex(sequence, len(patterns.vocabulary) + 1)
    low, high = index.search(patterns.windows, patterns.lengths)
    hits = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(hits)), hits)
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(hits)[:-1]]), hits) + np.arange(hits.sum())
    word = word[index.locate(rows)]
    return starts, ends, counts, text[word], word, window


def _spans_array(offsets: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def _found(texts: pa.Array, patterns: Patterns, shard_bytes: int) -> pa.Array:
    parts = []
    for s in slices(texts, shard_bytes, lower=True):
        starts, ends, counts, text, word, window = _search_shard(s, patterns)
        depth = np.zeros(len(starts) + 1, np.int64)
        np.add.at(depth, word, 1)
        np.add.at(depth, word + patterns.lengths[window] if len(word) else word, -1)
        hit = np.cumsum(depth)[:-1] > 0
        of = np.repeat(np.arange(s.n), counts)
        first = hit.copy()
        first[1:] &= ~hit[:-1] | (of[1:] != of[:-1])
        final = hit.copy()
        final[:-1] &= ~hit[1:] | (of[1:] != of[:-1])
        a, b = np.flatnonzero(first), np.flatnonzero(final)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of[a], minlength=s.n))])
        base = (np.cumsum(counts) - counts)[of[a]]
        items: list[set[int]] = [set() for _ in range(s.n)]
        if len(text):
            pairs = np.unique(text * np.int64(len(patterns.windows)) + window)
            for p in pairs.tolist():
                items[p // len(patterns.windows)].update(patterns.item_of[p % len(patterns.windows)].tolist())
        named = pa.array([sorted(patterns.item_ids[i] for i in found) for found in items], pa.list_(pa.string()))
        by_word = _spans_array(offsets, a - base, b - base + 1)
        by_byte = _spans_array(offsets, starts[a] - s.bounds[of[a]], ends[b] - s.bounds[of[a]])
        parts.append(pa.StructArray.from_arrays([pa.array(counts.astype(np.int64)), by_word, by_byte, named], names=FOUND.names))
    if not parts:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.array([], pa.struct([("n_words", pa.int64()), ("words", span), ("bytes", span), ("items", pa.list_(pa.string()))]))
    return pa.concat_arrays(parts)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[Patterns]:
    """The benchmark cut into blocks of bounded size, one after the other."""
    sized = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("b")
    )
    ranked = sized.withColumn("before", F.sum("b").over(Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = stored(ranked.select("item_id", "text", F.floor(F.coalesce("before", F.lit(0)) / block_bytes).alias("block")), "benchmark")
    blocks = [r.block for r in ranked.select("block").distinct().orderBy("block").collect()]
    found = []
    for block in blocks:
        rows = ranked.where(F.col("block") == block).orderBy("item_id").collect()
        found.append(Patterns.of([r.item_id for r in rows], [r.text for r in rows]))
    return found


def _union(spans: Column) -> Column:
    """Spans sorted and merged where they touch."""
    zero = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last.start.alias("start"), F.greatest(last.end, s.end).alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1).end >= s.start), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), zero, add)


def with_findings(docs: DataFrame, benchmark: DataFrame, name: str, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows and a struct of n_words, merged word and byte spans, and items found."""
    own = free_name(docs, "_found")
    blocks = benchmark_blocks(benchmark, block_bytes) or [Patterns.of([], [])]
    for k, patterns in enumerate(blocks):
        search = arrow_udf(lambda texts, p=patterns: _found(texts, p, shard_bytes), FOUND)
        # Else a filter on the findings would be moved below the search and repeat it.
        docs = docs.withColumn(f"{own}{k}", search.asNondeterministic()("text"))
    parts = [F.col(f"{own}{k}") for k in range(len(blocks))]
    if len(parts) == 1:
        return docs.withColumnRenamed(f"{own}0", name)
    merged = F.struct(
        parts[0].n_words.alias("n_words"),
        _union(F.concat(*[p["words"] for p in parts])).alias("words"),
        _union(F.concat(*[p["bytes"] for p in parts])).alias("bytes"),
        F.array_sort(F.flatten(F.array(*[p["items"] for p in parts]))).alias("items"),
    )
    return docs.withColumn(name, merged).drop(*[f"{own}{k}" for k in range(len(parts))])


def n_hit(found: Column) -> Column:
    return F.aggregate(found["words"], F.lit(0).cast("bigint"), lambda a, s: a + s.end - s.start)


def contaminated(found: Column) -> Column:
    return (n_hit(found) > 0) & (20 * n_hit(found) >= found["n_words"])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = with_findings(docs.select("doc_id", "text"), benchmark, "found")
    found = F.col("found")
    rows = rows.select("doc_id", "found", n_hit(found).alias("n_hit"))
    return rows.select(
        "doc_id", found.n_words.alias("n_words"), "n_hit", F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= found.n_words)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    name = free_name(docs, "_found")
    rows = with_findings(docs, benchmark, name)
    return rows.where(~contaminated(F.col(name))).select(*[column(c) for c in docs.columns])
