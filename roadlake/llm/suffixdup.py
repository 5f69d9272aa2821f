"""Removal of repeated 100-byte strings with a distributed, sparse suffix array.

A byte goes when some `LENGTH`-byte string that covers it also starts earlier (smaller
document id, or the same document and an earlier start). Sorting the suffix at every byte of
100 TB is not affordable, so suffixes are chosen first:

1. Anchors. Every window of LENGTH bytes has an anchor, the least-hashed `GRAM`-byte string
   inside it, so equal windows have equal anchors at equal places. Anchors (about one in 35
   bytes) are sorted in buckets by their gram and by the whole neighbourhood that all of their
   windows lie in. A gram found once settles its windows: no match. A neighbourhood seen
   earlier settles them too: all repeated. What is left is windows around the edges of
   repeated passages.
2. Suffixes. The suffixes at those windows are range-partitioned by their leading tokens: eight
   literal bytes, then a hash of the other 92. Splitters come from a sample. Buckets sort
   locally key by key; of equal suffixes the earliest stays and the others are repeats. A
   splitter is a whole key, so equal suffixes never lie on two sides of a boundary.

Tasks settle what they can before anything moves: a task sends an anchor neighbourhood or a
suffix once, and of a gram it has seen in several neighbourhoods only two examples, so a
passage that a third of all documents share is as many rows as there are tasks. Rows travel as packed
columns, one row per task and bucket; a bucket holds a fixed number of bytes of input.

Defined results: a null or empty text has no bytes and keeps nothing; a null id is left as it
is and matches nothing; rows that repeat an id share its place, so they do not make each other
repeats; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.llm.tables import free_name, sieve, stored
from roadlake.llm.textbytes import hashes, mix, slices

LENGTH = 100
GRAM = 32
SPREAD = LENGTH - GRAM  # an anchor lies at most so far behind its window's start
SLICE = 1 << 18
BUCKET_BYTES = 4 << 20  # input bytes per bucket of anchors
BUCKET_SUFFIXES = 1 << 18
FLUSH = 1 << 21  # anchors or suffixes a task settles at a time
PLACE_BITS = 20
FULL, TEST = 0, 1
_48 = np.uint64((1 << 48) - 1)
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _anchors(s) -> tuple[np.ndarray, ...]:
    """text, place in it, first and last window start relative to the place, gram, neighbourhood."""
    n = len(s.data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = s.prefix()
    start = np.arange(n - GRAM + 1)
    gram = hashes(prefix, start, start + GRAM)
    found = []
    step = (1 << PLACE_BITS) - SPREAD
    for low in range(0, n - LENGTH + 1, step):
        part = gram[low : low + step + SPREAD]
        key = (part >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= SPREAD + 1:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        key = np.minimum(key[: len(key) - (SPREAD + 1 - width)], key[SPREAD + 1 - width :])
        found.append((key & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) + low)
    anchor = np.concatenate(found)
    window = np.arange(len(anchor))
    text = np.repeat(np.arange(s.n), np.diff(s.bounds))[: len(anchor)]
    inside = window + LENGTH <= s.bounds[text + 1]
    window, anchor, text = window[inside], anchor[inside], text[inside]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window))[: len(first)] - 1
    place, text = anchor[first], text[first]
    left = np.maximum(place - SPREAD, s.bounds[text])
    right = np.minimum(place + LENGTH, s.bounds[text + 1])
    around = hashes(prefix, left, right) + (place - left).astype(np.uint64)
    return text, place - s.bounds[text], window[first] - place, window[last] - place, gram[place] & _48, mix(around) & _48


def _first_of(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in order: index (in order) of the first row with equal keys."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def _earlier(doc: np.ndarray, at: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """In order: whether the first of the equal rows starts earlier than the row."""
    d, p = doc[order], at[order]
    return (d[first] < d) | ((d[first] == d) & (p[first] < p))


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns.values()), "zstd", asbytes=True)


def _unpack(blob: bytes, n: int, types: list) -> list[np.ndarray]:
    size = sum(np.dtype(t).itemsize for t in types) * n
    raw, out, at = pa.decompress(blob, size, "zstd", asbytes=True), [], 0
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += np.dtype(t).itemsize * n
    return out


_MARK = "dest long, kind int, m long, windows long, pairs binary"
_SENT = f"bucket long, n long, blob binary, {_MARK}"
_PAIRS = [np.int64, np.int64, np.int32]
_ANCHOR = [np.uint64, np.uint64, np.int64, np.int64, np.int8, np.int8, np.bool_]
_SUFFIX = [np.uint64, np.uint64, np.int64, np.int64]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _marks(doc: np.ndarray, kind: int, start: np.ndarray, end: np.ndarray, groups: int) -> pa.RecordBatch:
    """Packed (document, start, length), a row per group of documents."""
    dest = (mix(doc.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((start, doc, dest))
    doc, start, length = doc[order], start[order], (end - start)[order].astype(np.int32)
    cuts = np.searchsorted(dest[order], np.arange(groups + 1))
    full = np.flatnonzero(np.diff(cuts))
    parts = [slice(a, b) for a, b in zip(cuts[full].tolist(), cuts[full + 1].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full, pa.int64()),
            pa.array(np.full(len(full), kind, np.int32)),
            pa.array([p.stop - p.start for p in parts], pa.int64()),
            pa.array([int(length[p].sum()) for p in parts], pa.int64()),
            pa.array([_pack({"d": doc[p], "s": start[p], "l": length[p]}) for p in parts], pa.binary()),
        ],
        names=_names(_MARK),
    )


def _unpack_marks(table: pa.Table) -> pa.Table:
    """One row per document: (start, end) pairs."""
    parts = [_unpack(b, n, _PAIRS) for b, n in zip(table.column("pairs").to_pylist(), table.column("m").to_pylist(), strict=True)]
    doc, start, length = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((start, doc))
    doc, pairs = doc[order], np.stack([start[order], start[order] + length[order]], axis=1)
    cuts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    return pa.table({"id": pa.array(doc[cuts], pa.int64()), "pairs": pa.array([p.tobytes() for p in np.split(pairs, cuts[1:])], pa.binary())})


def _per_document(marks: DataFrame) -> DataFrame:
    return marks.groupBy("dest").applyInArrow(_unpack_marks, "id long, pairs binary")


def _sent(marks: list[pa.RecordBatch], packed: list[tuple[int, int, bytes]], spread: int) -> Iterator[pa.RecordBatch]:
    """Rows for buckets; marks a task has settled itself go along to any bucket."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    if packed:
        b, n, blob = zip(*packed, strict=True)
        none = [pa.nulls(len(b), t) for t in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(blob, pa.binary()), *none], names=_names(_SENT))
    for m in marks:
        if len(m):
            bucket = m.column("dest").to_numpy() % spread
            none = [pa.nulls(len(m), t) for t in (pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *none, *m.columns], names=_names(_SENT))


def _settled_marks(table: pa.Table) -> pa.Table:
    return table.select(_names(_MARK)).filter(pa.compute.is_valid(table.column("dest")))


def _find_anchors(buckets: int, groups: int):
    def settle(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, at, low, high, gram, around = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((at, doc, around, gram))
        first = _first_of(order, gram, around)
        repeat = _earlier(doc, at, order, first)
        full = order[repeat]
        marks = [_marks(doc[full], FULL, at[full] + low[full], at[full] + high[full] + LENGTH, groups)]
        order = order[~repeat]
        # Of a gram with several neighbourhoods here, all need a test; two go out as examples.
        start = _first_of(order, gram)
        fresh = _first_of(order, gram, around)
        heads = np.flatnonzero(fresh == np.arange(len(order)))
        kinds = np.zeros(len(order), np.int64)
        np.add.at(kinds, start[heads], 1)
        nth = np.cumsum(np.isin(np.arange(len(order)), heads)) - 1
        nth = nth - nth[start] if len(order) else nth
        many = kinds[start] > 1 if len(order) else np.zeros(0, bool)
        test = order[many]
        marks.append(_marks(doc[test], TEST, at[test] + low[test], at[test] + high[test] + 1, groups))
        go = ~many | ((nth < 2) & np.isin(np.arange(len(order)), heads))
        order, shadow = order[go], many[go]
        bucket = (gram[order] * np.uint64(buckets) >> np.uint64(48)).astype(np.int64) if buckets < 1 << 16 else (gram[order] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        bucket, order, shadow = bucket[by], order[by], shadow[by]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        packed = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            o, sh = order[cuts[b] : cuts[b + 1]], shadow[cuts[b] : cuts[b + 1]]
            packed.append((b, len(o), _pack({"g": gram[o], "a": around[o], "d": doc[o], "p": at[o], "l": low[o].astype(np.int8), "h": high[o].astype(np.int8), "s": sh})))
        yield from _sent(marks, packed, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for s in slices(batch.column("text"), SLICE):
                text, *rest = _anchors(s)
                parts.append((ids[s.first + text], *rest))
                held += len(text)
                if held > FLUSH:
                    yield from settle(parts)
                    parts, held = [], 0
        if held:
            yield from settle(parts)

    return run


def _settle_anchors(groups: int):
    def run(table: pa.Table) -> pa.Table:
        sent = table.filter(pa.compute.is_valid(table.column("n")))
        found = [_settled_marks(table)]
        if len(sent):
            parts = [_unpack(b, n, _ANCHOR) for b, n in zip(sent.column("blob").to_pylist(), sent.column("n").to_pylist(), strict=True)]
            gram, around, doc, at, low, high, shadow = (np.concatenate(c) for c in zip(*parts, strict=True))
            low, high = low.astype(np.int64), high.astype(np.int64)
            order = np.lexsort((at, doc, around, gram))
            start, first = _first_of(order, gram), _first_of(order, gram, around)
            repeat = _earlier(doc, at, order, first)
            several = np.zeros(len(order), bool)
            np.logical_or.at(several, start, first != start)
            several = several[start]
            # A repeated row of one document may share its first place: it is tested with it.
            own = ~shadow[order]
            full, test = order[own & repeat], order[own & ~repeat & several]
            found.append(pa.Table.from_batches([
                _marks(doc[full], FULL, at[full] + low[full], at[full] + high[full] + LENGTH, groups),
                _marks(doc[test], TEST, at[test] + low[test], at[test] + high[test] + 1, groups),
            ]))
        return pa.concat_tables(found).combine_chunks()

    return run


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """doc, start, leading eight bytes, hash of the rest, at every window to test."""
    ids, pairs = batch.column("id").to_numpy(), batch.column("pairs")
    for s in slices(batch.column("text"), SLICE):
        starts, docs = [], []
        for k in range(s.n):
            spans = np.frombuffer(pairs[s.first + k].as_py(), np.int64).reshape(-1, 2)
            spans = spans[spans[:, 1] + LENGTH - 1 <= s.bounds[k + 1] - s.bounds[k]]  # not another text of the same id
            length = spans[:, 1] - spans[:, 0]
            places = np.repeat(spans[:, 0] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            starts.append(places + s.bounds[k])
            docs.append(np.full(len(places), k))
        if starts:
            at, k = np.concatenate(starts), np.concatenate(docs)
            lead = s.data[at[:, None] + np.arange(8)].copy().view(">u8").ravel().astype(np.uint64)
            yield ids[s.first + k], at - s.bounds[k], lead, hashes(s.prefix(), at + 8, at + LENGTH)


def _bucket(lead: np.ndarray, rest: np.ndarray, splitters: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of splitters at or below each key."""
    leads, rests = splitters
    low = np.searchsorted(leads, lead, "left")
    high = np.searchsorted(leads, lead, "right")
    for i in np.flatnonzero(low < high).tolist():
        low[i] += int(np.searchsorted(rests[low[i] : high[i]], rest[i], "right"))
    return low


def _sort_out(splitters: tuple[np.ndarray, np.ndarray], groups: int):
    def settle(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, at, lead, rest = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((at, doc, rest, lead))
        first = _first_of(order, lead, rest)
        repeat = _earlier(doc, at, order, first)
        gone = order[repeat]
        order = order[first == np.arange(len(order))]
        bucket = _bucket(lead[order], rest[order], splitters)  # ascending, as the order is
        cuts = np.searchsorted(bucket, np.arange(len(splitters[0]) + 2))
        packed = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            o = order[cuts[b] : cuts[b + 1]]
            packed.append((b, len(o), _pack({"l": lead[o], "r": rest[o], "d": doc[o], "p": at[o]})))
        yield from _sent([_marks(doc[gone], FULL, at[gone], at[gone] + LENGTH, groups)], packed, len(splitters[0]) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in _suffixes(batch):
                parts.append(part)
                held += len(part[0])
                if held > FLUSH:
                    yield from settle(parts)
                    parts, held = [], 0
        if held:
            yield from settle(parts)

    return run


def _settle_suffixes(groups: int):
    def run(table: pa.Table) -> pa.Table:
        sent = table.filter(pa.compute.is_valid(table.column("n")))
        found = [_settled_marks(table)]
        if len(sent):
            parts = [_unpack(b, n, _SUFFIX) for b, n in zip(sent.column("blob").to_pylist(), sent.column("n").to_pylist(), strict=True)]
            lead, rest, doc, at = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((at, doc, rest, lead))
            gone = order[_earlier(doc, at, order, _first_of(order, lead, rest))]
            found.append(pa.Table.from_batches([_marks(doc[gone], FULL, at[gone], at[gone] + LENGTH, groups)]))
        return pa.concat_tables(found).combine_chunks()

    return run


def _sample_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, lead, rest in _suffixes(batch):
            yield pa.RecordBatch.from_arrays([pa.array(lead[::16].view(np.int64)), pa.array(rest[::16].view(np.int64))], names=["lead", "rest"])


def _splitters(tested: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys between buckets, from the suffixes of a sample of at most about 2,000 documents."""
    if buckets < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    flip = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)))  # noqa: E731  unsigned order
    keys = tested.mapInArrow(_sample_keys, "lead long, rest long").select(flip("lead").alias("lead"), flip("rest").alias("rest"))
    ranked = keys.select(F.struct("lead", "rest").alias("k")).orderBy("k").collect()
    sign = np.uint64(1 << 63)
    lead = np.array([r.k.lead for r in ranked], np.int64).view(np.uint64) ^ sign
    rest = np.array([r.k.rest for r in ranked], np.int64).view(np.uint64) ^ sign
    pick = np.unique(np.linspace(0, max(len(lead) - 1, 0), buckets + 1)[1:-1].astype(int)) if len(lead) else np.zeros(0, int)
    keys = sorted(set(zip(lead[pick].tolist(), rest[pick].tolist(), strict=True)))
    return np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.uint64)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, pairs): packed start and end bytes of strings that also start earlier; they overlap."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where(F.octet_length("text") >= LENGTH).where("id is not null")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_BYTES))
    sent = texts.mapInArrow(_find_anchors(buckets, buckets), _SENT)
    marks = stored(sent.groupBy("bucket").applyInArrow(_settle_anchors(buckets), _MARK), "anchors")

    full = marks.where(F.col("kind") == FULL)
    tests = stored(_per_document(marks.where(F.col("kind") == TEST)), "tests")
    suffixes = marks.where(F.col("kind") == TEST).agg(F.sum("windows")).first()[0]
    if not suffixes:
        return _per_document(full)
    one_in = max(1, tests.count() // 2000)
    sampled = stored(tests.where(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0), "sample")
    splitters = _splitters(_with_text(texts, sampled), -(-suffixes // BUCKET_SUFFIXES))
    sent = _with_text(texts, tests).mapInArrow(_sort_out(splitters, buckets), _SENT)
    hits = stored(sent.groupBy("bucket").applyInArrow(_settle_suffixes(buckets), _MARK), "suffixes")
    return _per_document(full.unionByName(hits))


def _with_text(texts: DataFrame, grouped: DataFrame) -> DataFrame:
    return texts.where(sieve(grouped, "id")(F.col("id"))).join(grouped, "id").select("id", "text", "pairs")


@arrow_udf(T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("kept", T.BinaryType())]))
def _cut(texts: pa.Array, pairs: pa.Array) -> pa.Array:
    spans, kept = [], []
    for s in slices(texts, SLICE):
        for k in range(s.n):
            data = s.data[s.bounds[k] : s.bounds[k + 1]]
            both = np.frombuffer(pairs[s.first + k].as_py() or b"", np.int64).reshape(-1, 2)
            both = both[both[:, 1] <= len(data)]  # not another text of the same id
            depth = np.bincount(both[:, 0], minlength=len(data) + 1) - np.bincount(both[:, 1], minlength=len(data) + 1)
            gone = np.cumsum(depth)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            kept.append(data[~gone].tobytes())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(spans, span), pa.array(kept, pa.binary())], names=["spans", "kept"])


def remove_repeats(docs: DataFrame, name: str = "cut") -> DataFrame:
    """The rows with a struct of the removed byte spans and the remaining bytes."""
    grouped = stored(repeated_spans(docs), "spans")
    own = free_name(docs, "_spans")
    hit = sieve(grouped, "id")(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)))
    none = F.array().cast(T.ArrayType(SPAN))
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    marked = docs.withColumn(own, hit)
    clear = marked.where(~F.col(own)).drop(own).withColumn(name, F.struct(none.alias("spans"), whole.alias("kept")))
    right = grouped.select(F.col("id").alias(own + "id"), F.col("pairs").alias(own + "pairs"))
    joined = marked.where(F.col(own)).drop(own).join(right, F.col("doc_id").cast("bigint") == F.col(own + "id"), "left")
    return clear.unionByName(joined.withColumn(name, _cut("text", F.col(own + "pairs"))).drop(own + "id", own + "pairs"))


def removed(cut: Column) -> Column:
    return F.aggregate(cut["spans"], F.lit(0).cast("bigint"), lambda a, s: a + s.end - s.start)


def repeat_report(docs: DataFrame) -> DataFrame:
    rows = remove_repeats(docs.select("doc_id", "text"))
    cut = F.col("cut")
    return rows.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), removed(cut).alias("n_removed"),
        F.size(cut["spans"]).cast("bigint").alias("n_spans"), F.sha2(cut["kept"], 256).alias("kept_sha256"),
    )
