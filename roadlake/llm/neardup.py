"""Near-duplicate documents by chosen-path set similarity join.

A document's set is its distinct five-word shingles, as 64-bit hashes over the whole text.
Documents with equal sets (same size and two 64-bit fingerprints) share a representative.
Each representative keeps `POSITIONS` minwise tokens and a bit of each of `BITS` more.
Independent trees branch it
recursively: a node selects one token position, with chance 1 / SIMILARITY - 1 a second one,
and passes each document on by its token there, so a pair as similar as the threshold
expects one shared path per level. Nodes of at most `SMALL` documents are compared exhaustively; larger ones branch
on, down to `DEPTH`, where they are cut into chunks that share a few leaders. All pairs a
node finds plausible (estimate from the bits of at least `PLAUSIBLE`, sizes within the
threshold) are confirmed on the full shingle sets recomputed from the texts.

Large groups of copies never give all their pairs. A node first proposes a spanning forest
of its plausible pairs. After confirmation, members that still have a plausible partner in
another component meet again with their full sets, in blocks if the node was cut, and each
block gives a spanning forest of its links. A pair inside one component needs no
comparison, so no link between components is lost.

Defined results: null, empty or blank text has an empty set and is linked with nothing; with
one to four words the whole sequence is the only shingle; a null id is never linked and is
kept; rows that repeat an id are one document, of which `keep_one_each` keeps one row; an
empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from roadlake.llm.tables import column, sieve, stored
from roadlake.llm.textbytes import NOT_SPACE, constants, hashes, mix, slices, word_spans

SIMILARITY = (85, 100)  # links: 100 * intersection >= 85 * union
WORDS = 5
POSITIONS = 128
BITS = 256
TREES = 10
SMALL = 256
FEW = 8  # nodes up to this size propose all plausible pairs at once
DEPTH = 6
LEADERS = 8
# The estimate of a pair at the threshold has a standard deviation of 0.033.
PLAUSIBLE = 0.70
SECOND = 1 / 0.85 - 1

_SHINGLE = constants(WORDS, 5)
_SHORT = constants(WORDS, 50)
_XOR = (constants(BITS, 1) >> np.uint64(32)).astype(np.uint32)[:, None]
_ODD = (constants(BITS, 2) >> np.uint64(31)).astype(np.uint32)[:, None] | np.uint32(1)
_ROOTS = constants(TREES, 3)
SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("fa", T.LongType()),
        T.StructField("fb", T.LongType()),
        T.StructField("sig", T.BinaryType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for s in slices(texts, lower=True):
        starts, ends, counts = word_spans(s, NOT_SPACE)
        w = hashes(s.prefix(), starts, ends)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        h = np.zeros(0, np.uint64)
        if len(w) >= WORDS:
            m = len(w) - WORDS + 1
            h = mix(sum((w[k : m + k] * _SHINGLE[k] for k in range(1, WORDS)), w[:m] * _SHINGLE[0]))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= WORDS:
                yield np.unique(h[a : b - WORDS + 1])
            elif b > a:
                yield mix((w[a:b] * _SHORT[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def minwise(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """16 bits of the minwise token at each of POSITIONS, one bit of it at each of BITS."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BITS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, ((x[at : at + 1024] ^ _XOR) * _ODD).min(axis=1), out=least)
    mixed = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> np.uint32(13)
    return (mixed[:POSITIONS] >> np.uint32(16)).astype(np.uint16).tobytes(), np.packbits(mixed & 1 == 1).tobytes()


@arrow_udf(SKETCH)
def sketch(texts: pa.Array) -> pa.Array:
    n, fa, fb, least = [], [], [], []
    for u in shingle_sets(texts):
        n.append(len(u))
        fa.append(mix(u).sum().view(np.int64) if len(u) else 0)
        fb.append(mix(u ^ _SHINGLE[0]).sum().view(np.int64) if len(u) else 0)
        least.append(minwise(u) if len(u) else (b"", b""))
    arrays = [pa.array(np.array(c, np.int64)) for c in (n, fa, fb)] + [pa.array([m[k] for m in least], pa.binary()) for k in range(2)]
    return pa.StructArray.from_arrays(arrays, names=SKETCH.names)


@arrow_udf(T.BooleanType())
def linked(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether the full sets of two texts are similar enough."""
    found = []
    for a, b in zip(shingle_sets(left), shingle_sets(right), strict=True):
        common = len(np.intersect1d(a, b, assume_unique=True))
        found.append(common > 0 and SIMILARITY[1] * common >= SIMILARITY[0] * (len(a) + len(b) - common))
    return pa.array(found, pa.bool_())


@arrow_udf(T.BinaryType())
def packed_set(texts: pa.Array) -> pa.Array:
    return pa.array([u.tobytes() for u in shingle_sets(texts)], pa.binary())


def _fixed(batch: pa.RecordBatch, name: str, kind: type, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(-1, width)


def _signatures(batch: pa.RecordBatch) -> np.ndarray:
    return _fixed(batch, "sig", np.uint16, POSITIONS)


def _children(path: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row indices and node of the selected branches; the selection depends on the path alone."""
    first = (mix(path ^ _SHINGLE[1]) % np.uint64(POSITIONS)).astype(np.int64)
    second = (mix(path ^ _SHINGLE[2]) % np.uint64(POSITIONS)).astype(np.int64)
    also = (mix(path ^ _SHINGLE[3]) >> np.uint64(11)).astype(np.float64) / 2**53 < SECOND
    rows = np.arange(len(path))
    for at, chosen in ((rows, first), (rows[also & (first != second)], second)):
        position = chosen[at]
        token = sig[at, position].astype(np.uint64)
        yield at, mix(path[at] * _SHINGLE[4] + mix(position.astype(np.uint64) << np.uint64(20) | token))


_NODE = "node long, rep long"


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig, rep = _signatures(batch), batch.column("rep").to_numpy()
        for root in _ROOTS:
            for at, node in _children(np.full(len(rep), root), sig):
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rep[at])], names=["node", "rep"])


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        path = batch.column("node").to_numpy().astype(np.int64).view(np.uint64)
        rep = batch.column("rep").to_numpy()
        for at, node in _children(path, _signatures(batch)):
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rep[at])], names=["node", "rep"])


def _plausible(n: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Estimated similarities of all pairs of a node; 0 where sizes or the estimate rule a link out."""
    apart = np.zeros((len(n), len(n)), np.int32)
    for k in range(bits.shape[1]):
        apart += np.bitwise_count(bits[:, k, None] ^ bits[:, k])
    estimate = 1 - 2 * apart.astype(np.float32) / BITS
    low, high = np.minimum(n[:, None], n), np.maximum(n[:, None], n)
    estimate[(SIMILARITY[1] * low < SIMILARITY[0] * high) | (estimate < PLAUSIBLE)] = 0
    np.fill_diagonal(estimate, 0)
    return estimate


def _forest(estimate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of largest estimates (Prim, a row at a time)."""
    m = len(estimate)
    best, parent = estimate[0].copy(), np.zeros(m, np.int64)
    best[0], left, right = -1.0, [], []
    for _ in range(m - 1):
        i = int(best.argmax())
        if best[i] > 0:
            left.append(int(parent[i]))
            right.append(i)
        closer = (estimate[i] > best) & (best >= 0)
        best[closer], parent[closer] = estimate[i][closer], i
        best[i] = -1.0
    return np.array(left, np.int64), np.array(right, np.int64)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal node, across batches."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        node = rows.column("node").to_numpy()
        cuts = np.flatnonzero(node[1:] != node[:-1]) + 1
        for a, b in zip(np.concatenate([[0], cuts[:-1]]).astype(int), cuts, strict=True) if len(cuts) else ():
            yield rows.slice(a, b - a)
        rest = rows.slice(int(cuts[-1]) if len(cuts) else 0)
    if rest is not None and len(rest):
        yield rest


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of plausible pairs of each node; all plausible pairs of few."""
    pending: list[np.ndarray] = []
    for rows in _nodes(batches):
        batch = rows.combine_chunks().to_batches()[0]
        rep, n = batch.column("rep").to_numpy(), batch.column("n").to_numpy()
        estimate = _plausible(n, _fixed(batch, "bits", np.uint64, BITS // 64))
        if not estimate.any():
            continue
        i, j = _forest(estimate) if len(rep) > FEW else np.nonzero(np.triu(estimate))
        pending.append(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])]))
        if sum(p.shape[1] for p in pending) > 10000:
            yield _pairs(pending)
            pending = []
    if pending:
        yield _pairs(pending)


def _apart(label: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Pairs of different components, but for pairs that meet in another block."""
    return (label[:, None] != label) & ~((side[:, None] == 1) & (side == 1))


def _suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of a node that have a plausible partner in another component."""
    for rows in _nodes(batches):
        batch = rows.combine_chunks().to_batches()[0]
        label, side = batch.column("label").to_numpy(), batch.column("side").to_numpy()
        estimate = _plausible(batch.column("n").to_numpy(), _fixed(batch, "bits", np.uint64, BITS // 64))
        open_ones = ((estimate > 0) & _apart(label, side)).any(axis=1)
        if open_ones.any():
            yield batch.select(["node", "rep", "label", "side"]).filter(pa.array(open_ones))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components inside a node, from full sets: a spanning forest of them."""
    for rows in _nodes(batches):
        rep, label, side = (rows.column(c).to_numpy() for c in ("rep", "label", "side"))
        sets = [np.frombuffer(b, np.uint64) for b in rows.column("shingles").to_pylist()]
        n = np.array([len(u) for u in sets])
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), n)
        shared = count[column] > 1
        row, column = row[shared], (np.cumsum(count > 1) - 1)[column[shared]]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[row[a:b], column[a:b] - low] = 1
            common += part @ part.T
        close = SIMILARITY[1] * common >= SIMILARITY[0] * (n[:, None] + n - common)
        i, j = np.nonzero(np.triu((close & _apart(label, side)) | (close & _apart(label, side)).T))
        root = {x: x for x in label.tolist()}

        def top(x: int, root: dict[int, int] = root) -> int:
            while root[x] != x:
                x = root[x]
            return x

        found = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            u, v = top(int(label[a])), top(int(label[b]))
            if u != v:
                root[max(u, v)] = min(u, v)
                found.append(sorted((int(rep[a]), int(rep[b]))))
        if found:
            yield _pairs([np.array(found, np.int64).T])


def _pairs(parts: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate(parts, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def tree_nodes(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes to compare, (node, rep): small ones, and chunks of those still large at the end
    with the whole node they come from (node, rep, whole, chunk)."""
    spark = reps.sparkSession
    rows = stored(reps.select("rep", "sig").mapInArrow(_plant, _NODE), "paths")
    small: list[DataFrame] = []
    chunks = spark.createDataFrame([], "node long, rep long, whole long, chunk long")
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        several = rows.join(counts, "node")
        members = several.where(F.col("n") <= SMALL).groupBy("node").agg(F.sort_array(F.collect_list("rep")).alias("members"))
        # The same few copies meet in most trees: one node of them is enough.
        small.append(members.select("members").distinct().select(F.xxhash64("members").alias("node"), F.explode("members").alias("rep")))
        large = stored(several.where(F.col("n") > SMALL), "large")
        if large.isEmpty():
            break
        if depth < DEPTH:
            rows = stored(large.join(reps.select("rep", "sig"), "rep").select("node", "rep", "sig").mapInArrow(_branch, _NODE), "paths")
        else:
            share = F.ceil(F.col("n") / (SMALL - LEADERS)).cast("bigint")
            chunks = large.select("rep", F.col("node").alias("whole"), "n", F.pmod(F.xxhash64("rep"), share).alias("chunk"), share.alias("k"))
            # Leaders go to every chunk of their node.
            nth = chunks.groupBy("whole", "k").agg(F.min("rep").alias("l0"), *[
                F.min_by("rep", F.xxhash64("rep", F.lit(i))).alias(f"l{i}") for i in range(1, LEADERS)
            ])
            leader = F.explode(F.array_distinct(F.array(*[F.col(f"l{i}") for i in range(LEADERS)])))
            leaders = nth.select("whole", "k", leader.alias("rep")).select(
                "whole", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("chunk"), "rep"
            )
            chunks = chunks.select("whole", "chunk", "rep").union(leaders.select("whole", "chunk", "rep")).distinct()
            chunks = stored(chunks.select(F.xxhash64("whole", "chunk").alias("node"), "rep", "whole", "chunk"), "chunks")
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.union(more)
    return stored(nodes, "nodes"), chunks


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where(sieve(wanted, "id")(F.col("id")))
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return stored(both.where(linked("left", "right")).select("a", "b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex each linked vertex can reach."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near.withColumnRenamed("a", "v"), "v").select("v", "label", F.least("label", "near").alias("next"))
        jumped = least.join(labels.select(F.col("v").alias("next"), F.col("label").alias("far")), "next")
        after = stored(jumped.select("v", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("moved")), "labels")
        labels = after.select("v", "label")
        if after.where("moved").isEmpty():
            return labels


def find_links(docs: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confirmed links between representatives that give the components, and their labels."""
    narrow = reps.select("rep", "n", "bits")
    small, chunks = tree_nodes(reps)
    first = small.unionByName(chunks.select("node", "rep")).join(narrow, "rep")
    links = _confirmed(_by_node(first).mapInArrow(_propose, "a long, b long").distinct(), docs)
    labels = components(links)

    # Nodes above FEW that still hold several components.
    def labelled(nodes: DataFrame) -> DataFrame:
        known = labels.select(F.col("v").alias("rep"), "label")
        return nodes.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))

    kinds = [F.count(F.lit(1)).alias("m"), F.min("label").alias("low"), F.max("label").alias("high")]
    mixed = labelled(small).groupBy("node").agg(*kinds).where((F.col("m") > FEW) & (F.col("low") < F.col("high")))
    again = labelled(small.join(mixed.select("node"), "node", "left_semi")).select("node", "rep", "label", F.lit(0).alias("side"))

    # Of a node in chunks, every component but the largest meets all members, block by block.
    members = labelled(chunks.select("whole", "rep").distinct())
    sizes = members.groupBy("whole", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("whole").agg(F.max_by("label", "m").alias("most"), F.sum("m").alias("all"), F.max("m").alias("m"))
    open_ones = members.join(largest.where(F.col("m") < F.col("all")), "whole")
    half = SMALL // 2
    blocks = open_ones.withColumns({
        "pieces": F.ceil((F.col("all") - F.col("m")) / half).cast("bigint"), "alls": F.ceil(F.col("all") / half).cast("bigint"),
    })
    few = blocks.where("label <> most").select(
        "whole", "rep", "label", F.pmod(F.xxhash64("rep"), "pieces").alias("piece"), F.explode(F.sequence(F.lit(0), F.col("alls") - 1)).alias("part"), F.lit(0).alias("side")
    )
    rest = blocks.select(
        "whole", "rep", "label", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.pmod(F.xxhash64("rep", F.lit(7)), "alls").alias("part"), F.lit(1).alias("side")
    )
    crossed = few.unionByName(rest).select(F.xxhash64("whole", "piece", "part").alias("node"), "rep", "label", "side")
    again = _by_node(again.unionByName(crossed).join(narrow, "rep"))
    member = "node long, rep long, label long, side int"
    again = stored(again.select("node", "rep", "label", "side", "n", "bits").mapInArrow(_suspect, member), "again")
    if again.isEmpty():
        return links, labels
    wanted = again.select("rep").distinct()
    sets = docs.where(sieve(wanted, "rep")(F.col("doc_id"))).join(wanted, F.col("doc_id") == F.col("rep")).select("rep", packed_set("text").alias("shingles"))
    met = _by_node(again.join(sets, "rep").select("node", "rep", "label", "side", "shingles")).mapInArrow(_meet, "a long, b long")
    links = stored(links.unionByName(met).distinct(), "links")
    return links, components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketched = stored(narrow.select("doc_id", sketch("text").alias("s")).select("doc_id", "s.*"), "sketches")
    able = sketched.where("n > 0 and doc_id is not null")
    classes = stored(able.groupBy("n", "fa", "fb").agg(F.min("doc_id").alias("rep")), "classes")
    reps = able.join(classes.select("n", "fa", F.col("rep").alias("doc_id")), ["n", "fa", "doc_id"])
    reps = stored(reps.select(F.col("doc_id").alias("rep"), "n", "sig", "bits").dropDuplicates(["rep"]), "reps")
    _, labels = find_links(narrow, reps)
    # An id that stands for several texts joins their components.
    of_class = classes.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left")
    of_class = of_class.select("n", "fa", "fb", F.coalesce("label", "rep").alias("label"))
    found = sketched.join(of_class, ["n", "fa", "fb"], "left").select("doc_id", "n", "label")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("label")), F.col("doc_id"))
    rows = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each component, its smallest id; null ids stay."""
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, docs["doc_id"].cast("bigint") == kept["doc_id"], "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(column("doc_id").isNull()))
