"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Texts are taken in slices of about SLICE_BYTES (a longer text is a slice of its own). In a slice
the token streams of all texts lie end to end, so its matrices are block-diagonal and small:

* A and B, tokens x bytes, are incidence matrices in compressed sparse rows (CSR), built by
  hand; Gustavson's row products A * B^T give the overlap links with their shared bytes. What
  they connect is a group: it ends where tokens of both end;
* P, (text, A id) x group, and Q, group x B id, count occurrences; the row products P * Q give
  each text's linked id pairs with their numbers of links, without a row per pair of occurrences.

Products run in blocks of rows of a bounded number of terms, so memory follows the slice, the
block and the longest text. Slices of about CHUNK_BYTES together are a chunk.

A chunk ships each of its id pairs once, with the number of its texts that hold it. Those are
summed over the corpus, compared within their A id (which has at most as many pairs as B has ids), and
the counts go back to the chunks that asked. No table of pairs is broadcast or collected; what
meets in one task is one chunk.

Tokens are found per word: a cut before a single space between two printable ASCII signs
separates both tokenizers exactly (checked against the vocabulary of B when it is loaded),
so each distinct word of a slice is encoded once. For that, words are joined to texts
again, whose tokens fall apart at the same cuts. The public libraries do the encoding.

Defined results: texts that are null or empty, or whose joined token bytes differ from a space
and the text, have no tokens: zeros and an empty string; rows that repeat or share an id are
texts of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkContext, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlake.llm.tables import stored

CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 19
JOINED_BYTES = 1 << 16
BLOCK_TERMS = 1 << 20
FOLDER = "/opt/tokenizers"
FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SPACE = "▁"
# Fixed value: how A's byte-level pre-tokenizer splits.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Signs outside these old blocks may be letters to one version of Unicode and unassigned to another.
_RECENT = re.compile("[^\0-ɏЀ-џぁ-ゖァ-ヺ一-龥]")


# --- sparse matrices ----------------------------------------------------------------


@dataclass
class Csr:
    """Rows of (column, value), compressed: row i is [starts[i], starts[i + 1])."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @property
    def n(self) -> int:
        return len(self.starts) - 1

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, n: int, n_columns: int) -> Csr:
        """From coordinates in any order; what repeats is added up."""
        key = np.sort(rows * n_columns + columns)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        head = key[at]
        return Csr(np.searchsorted(head, np.arange(n + 1) * n_columns), head % n_columns, np.diff(np.append(at, len(key))))

    def transposed(self, n_columns: int) -> Csr:
        rows = np.repeat(np.arange(self.n), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        return Csr(np.searchsorted(self.columns[order], np.arange(n_columns + 1)), rows[order], self.values[order])


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each run, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def gustavson(left: Csr, right: Csr, block: int = BLOCK_TERMS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of left * right, by row, columns ascending within a row.

    A row of the product is the sum of the right rows that its left row names. Rows are taken in
    blocks of about `block` terms (one row may have more), whose sums are formed by sorting.
    """
    widths = np.diff(right.starts)[left.columns]
    terms = np.concatenate([[0], np.cumsum(widths)])[left.starts]
    first = 0
    while first < left.n:
        last = max(first + 1, int(np.searchsorted(terms, terms[first] + block, side="right")) - 1)
        inner = slice(left.starts[first], left.starts[last])
        named, width = left.columns[inner], widths[inner]
        at = expand(right.starts[named], width)
        rows = np.repeat(np.repeat(np.arange(first, last), np.diff(left.starts[first : last + 1])), width)
        values = np.repeat(left.values[inner], width) * right.values[at]
        columns = right.columns[at]
        if len(columns):
            span = int(columns.max()) + 1
            key = rows * span + columns
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield key[heads] // span, key[heads] % span, np.add.reduceat(values[order], heads)
        first = last


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens x bytes of a stream of tokens of the given byte lengths."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64))


def overlap_links(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(A tokens, B tokens, shared bytes) of all pairs of tokens that share bytes."""
    return gustavson(incidence(a_lengths), incidence(b_lengths).transposed(int(b_lengths.sum())))


def group_of(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each A and B token, and how many groups there are.

    Overlap links connect a group: a token of A is in the group of the one before it where the
    last B token of that one is its own first, so that no place between them ends both.
    """
    n = len(a_lengths)
    b_groups, groups, reached = np.zeros(len(b_lengths), np.int64), -1, -1
    a_groups = np.zeros(n, np.int64)
    for rows, columns, _ in overlap_links(a_lengths, b_lengths):
        heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        tokens = rows[heads]
        first, last = columns[heads], columns[np.append(heads[1:], len(rows)) - 1]
        opened = first != np.concatenate([[reached], last[:-1]])
        a_groups[tokens] = groups + np.cumsum(opened)
        b_groups[columns] = a_groups[rows]
        groups, reached = int(a_groups[tokens[-1]]), int(last[-1])
    return a_groups, b_groups, groups + 1


# --- tokenizers -------------------------------------------------------------------------


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_buffer(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        vocabulary = json.loads(a_file)
        entries = {**vocabulary["model"]["vocab"], **{t["content"]: t["id"] for t in vocabulary["added_tokens"]}}
        a_tokens: list[bytes] = [b""] * (max(entries.values()) + 1)
        decode = _byte_level()
        for entry, i in entries.items():
            a_tokens[i] = bytes(decode[c] for c in entry) if all(c in decode for c in entry) else entry.encode()
        b_tokens = []
        self.words_apart = True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_tokens.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
            # A piece with a space behind another sign could reach from one word into the next.
            self.words_apart &= SPACE not in piece.lstrip(SPACE) or self.b.is_control(i)
        self.tokens = (_table(a_tokens), _table(b_tokens))
        # Where ids are ranks of merges, the ranks give the same tokens four times as fast.
        merges = [m if isinstance(m, list) else m.split(" ") for m in vocabulary["model"]["merges"]]
        special = [t["id"] for t in vocabulary["added_tokens"]]
        ranked = all(entries[left + right] == 256 + rank for rank, (left, right) in enumerate(merges))
        ranks = {t: i for i, t in enumerate(a_tokens) if i not in special}
        self.ranks_a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranked else None

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a whole text: A's with a space before it (B adds its own)."""
        if self.ranks_a and _usual(text):
            a = self.ranks_a.encode_ordinary(" " + text)
        else:
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        return np.array(a, np.int64), np.array(self.b.encode(text), np.int64)


def _usual(text: str) -> bool:
    return text.isascii() or not _RECENT.search(text)


def _byte_level() -> dict[str, int]:
    """Sign of a byte-level vocabulary to byte: printable Latin-1 stands for itself, the other
    bytes follow from 256 on, in order."""
    printable = {b for b in range(256) if chr(b).isprintable() and chr(b) != " "}
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + n): b for n, b in enumerate(others)}}


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of all tokens."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    return offsets, np.frombuffer(b"".join(tokens), np.uint8)


@cache
def _loaded(files: Broadcast) -> Tokenizers:
    return Tokenizers(*files.value)


# --- a slice ------------------------------------------------------------------------------


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word, and how many words each text has; a word after the first of its text
    begins with the space that it was cut at."""
    printable = (data > 0x20) & (data < 0x7F)
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 0x20) & printable[:-2] & printable[2:]
    first = bounds[:-1][np.diff(bounds) > 0]
    # A text's own first and last place are no cut: its neighbours there are other texts.
    cut[first] = True
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    cut[ends[~np.isin(ends, first)]] = False
    starts = np.flatnonzero(cut)
    return starts, np.diff(np.searchsorted(starts, bounds))


@dataclass
class Stream:
    """Token ids of all texts of a slice end to end, and the number of each text's."""

    ids: np.ndarray
    counts: np.ndarray


@dataclass
class Vocabulary:
    """Ids of each distinct word, end to end, and whether their bytes are the word's."""

    ids: np.ndarray
    sizes: np.ndarray
    exact: np.ndarray


def _runs(tokenizers: Tokenizers, words: list[bytes]) -> Iterator[tuple[list[int], bytes]]:
    """Words to be encoded as one text: those that begin and end printable, some KB together,
    those with unusual signs apart; and every other word alone."""
    open_runs: dict[bool, list[int]] = {True: [], False: []}
    held = {True: 0, False: 0}
    for i, word in enumerate(words):
        if not (tokenizers.words_apart and 0x20 < word[0] < 0x7F and 0x20 < word[-1] < 0x7F):
            yield [i], word
            continue
        kind = word.isascii() or _usual(word.decode())
        open_runs[kind].append(i)
        held[kind] += len(word)
        if held[kind] > JOINED_BYTES:
            yield open_runs[kind], b" ".join([words[k] for k in open_runs[kind]])
            open_runs[kind], held[kind] = [], 0
    for run in open_runs.values():
        if run:
            yield run, b" ".join([words[k] for k in run])


def _encoded(tokenizers: Tokenizers, words: list[bytes]) -> list[Vocabulary]:
    """Both tokenizers' ids of distinct words."""
    lengths = np.array([len(w) for w in words], np.int64) + 1  # with the space before
    order, parts, counts, exact = [], ([], []), ([], []), ([], [])
    for run, text in _runs(tokenizers, words):
        wanted = np.frombuffer(b" " + text, np.uint8)
        ends = np.cumsum(lengths[run])
        order.extend(run)
        for side, ids in enumerate(tokenizers.encode(text.decode())):
            offsets, signs = tokenizers.tokens[side]
            sizes = np.diff(offsets)[ids]
            joined = signs[expand(offsets[ids], sizes)]
            if len(joined) == len(wanted) and (joined == wanted).all():
                word = np.searchsorted(ends, np.cumsum(sizes))
                counts[side].append(np.bincount(word, minlength=len(run)))
                exact[side].append(np.ones(len(run), bool))
            elif len(run) > 1:  # some word is not reproduced: each for itself
                alone = [tokenizers.encode(words[i].decode())[side] for i in run]
                made = [signs[expand(offsets[x], np.diff(offsets)[x])].tobytes() for x in alone]
                ids = np.concatenate(alone)
                counts[side].append(np.array([len(x) for x in alone]))
                exact[side].append(np.array([m == b" " + words[i] for m, i in zip(made, run, strict=True)]))
            else:
                counts[side].append(np.array([len(ids)]))
                exact[side].append(np.zeros(1, bool))
            parts[side].append(ids)
    out = []
    place = np.argsort(np.array(order, np.int64))
    for side in (0, 1):
        sizes = np.concatenate(counts[side])
        starts = np.cumsum(sizes) - sizes
        ids = np.concatenate(parts[side])[expand(starts[place], sizes[place])]
        out.append(Vocabulary(ids, sizes[place], np.concatenate(exact[side])[place]))
    return out


def _reproduced(tokenizers: Tokenizers, side: int, ids: np.ndarray, text: bytes) -> bool:
    offsets, signs = tokenizers.tokens[side]
    return signs[expand(offsets[ids], np.diff(offsets)[ids])].tobytes() == b" " + text


def tokenized(tokenizers: Tokenizers, data: np.ndarray, bounds: np.ndarray) -> tuple[Stream, Stream]:
    """Streams of both tokenizers; texts that they do not reproduce have no tokens."""
    texts = len(bounds) - 1
    if tokenizers.words_apart:
        starts, words_per_text = _words(data, bounds)
    else:
        full = np.diff(bounds) > 0
        starts, words_per_text = bounds[:-1][full], full.astype(np.int64)
    if not len(starts):
        return Stream(starts, words_per_text), Stream(starts, words_per_text)
    lengths = np.diff(np.append(starts, len(data)))
    # A word after the first of its text goes without its space: that is added again.
    inner = np.ones(len(starts), np.int64)
    inner[np.isin(starts, bounds)] = 0
    offsets = np.concatenate([[0], np.cumsum(lengths - inner)])
    keep = np.ones(len(data), bool)
    keep[starts[inner == 1]] = False
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[keep])])
    distinct = words.dictionary_encode()
    of = distinct.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(texts), words_per_text)
    good = np.diff(bounds) > 0
    streams = []
    for side, found in enumerate(_encoded(tokenizers, distinct.dictionary.to_pylist())):
        first = np.cumsum(found.sizes) - found.sizes
        sizes = found.sizes[of]
        counts = np.bincount(text, weights=sizes, minlength=texts).astype(np.int64)
        stream = Stream(found.ids[expand(first[of], sizes)], counts)
        streams.append(stream)
        ends = np.cumsum(counts)
        for t in np.unique(text[~found.exact[of]]):
            whole = data[bounds[t] : bounds[t + 1]].tobytes()
            good[t] &= _reproduced(tokenizers, side, stream.ids[ends[t] - counts[t] : ends[t]], whole)
    for stream in streams:
        stream.ids = stream.ids[np.repeat(good, stream.counts)]
        stream.counts = np.where(good, stream.counts, 0)
    return streams[0], streams[1]


def _written(a: Stream, b: Stream, a_groups: np.ndarray, b_groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3` of every text, as one array of bytes with bounds."""
    side = np.concatenate([np.zeros(len(a.ids), np.int64), np.ones(len(b.ids), np.int64)])
    groups = np.concatenate([a_groups, b_groups])
    texts = np.concatenate([np.repeat(np.arange(len(x.counts)), x.counts) for x in (a, b)])
    order = np.argsort(groups * 2 + side, kind="stable")
    ids, side, groups, texts = np.concatenate([a.ids, b.ids])[order], side[order], groups[order], texts[order]
    n, digits = len(ids), len(str(int(ids.max(initial=0))))
    signs = np.zeros((n, digits + 1), np.uint8)
    for d in range(digits):
        signs[:, d] = ids // 10 ** (digits - 1 - d) % 10 + 48
    # What follows: another id of the same side, the other side, another group, or the end.
    same_text = np.append(texts[1:] == texts[:-1], False)
    same_group = np.append(groups[1:] == groups[:-1], False)
    same_side = np.append(side[1:] == side[:-1], False)
    signs[:, digits] = np.where(~same_group, ord(";"), np.where(same_side, ord(","), ord("|")))
    width = 1 + np.searchsorted(10 ** np.arange(1, digits), ids, side="right")
    shown = np.arange(digits + 1) >= (digits - width)[:, None]
    shown[:, digits] = same_text
    sizes = shown.sum(1)
    return signs[shown], np.concatenate([[0], np.cumsum(np.bincount(texts, weights=sizes, minlength=len(a.counts)).astype(np.int64))])


B_BITS = 24  # an id pair is A's id above this many bits of B's id


@dataclass
class Aligned:
    """What is known of each text of a slice or chunk, and its id pairs with their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: np.ndarray
    n_pairs: np.ndarray
    pair: np.ndarray
    links: np.ndarray


def align(tokenizers: Tokenizers, data: np.ndarray, bounds: np.ndarray) -> Aligned:
    a, b = tokenized(tokenizers, data, bounds)
    texts = len(bounds) - 1
    (a_offsets, _), (b_offsets, _) = tokenizers.tokens
    a_groups, b_groups, n = group_of(np.diff(a_offsets)[a.ids], np.diff(b_offsets)[b.ids])
    a_text = np.repeat(np.arange(texts), a.counts)
    # Rows of P: the A ids of each text.
    span = len(a_offsets)
    key = np.sort((a_text * span + a.ids) * max(n, 1) + a_groups)
    rows = np.unique(key // max(n, 1))
    p = Csr.of(np.searchsorted(rows, key // max(n, 1)), key % max(n, 1), len(rows), max(n, 1))
    q = Csr.of(b_groups, b.ids, n, len(b_offsets))
    parts = list(gustavson(p, q))
    row, column, links = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else [()] * 3))
    pair = (rows[row] % span << B_BITS) + column
    n_pairs = np.bincount(rows[row] // span, minlength=texts)
    group_text = np.zeros(n, np.int64)
    group_text[a_groups] = a_text
    written, written_bounds = _written(a, b, a_groups, b_groups)
    raw = written.tobytes()
    spans = zip(written_bounds, written_bounds[1:], strict=False)
    digests = np.array([hashlib.sha256(raw[x:y]).hexdigest() if y > x else "" for x, y in spans], object)
    return Aligned(a.counts, b.counts, np.bincount(group_text, minlength=texts), digests, n_pairs, pair, links)


# --- the corpus -----------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers by byte plane: the planes of zeros compress away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_ALIGNED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places binary, links binary, pairs array<long>, holders array<int>"
)
_ALIGNED_ARROW = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("places", pa.binary()), ("links", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())),
])


def _chunk_rows(chunk: int, doc_ids: list, slices: list[Aligned]) -> Iterator[pa.RecordBatch]:
    """A row per text, and one (without n_a) with the chunk's pairs and in how many texts each is."""
    c = Aligned(*[np.concatenate([getattr(s, f.name) for s in slices]) for f in fields(Aligned)])
    pairs, place, holders = np.unique(c.pair, return_inverse=True, return_counts=True)
    sums = np.concatenate([[0], np.cumsum(c.links)])
    starts = np.concatenate([[0], np.cumsum(c.n_pairs)])
    spans = list(zip(starts, starts[1:], strict=False))
    n = len(doc_ids)
    none = lambda kind: pa.nulls(n, kind)
    yield pa.RecordBatch.from_arrays([
        pa.array([chunk] * n, pa.int64()), pa.array(doc_ids, pa.int64()), *[pa.array(x, pa.int64()) for x in (c.n_a, c.n_b, c.n_groups)],
        pa.array(np.diff(sums[starts]), pa.int64()), pa.array(c.digests, pa.string()),
        pa.array([_packed(np.diff(place[x:y], prepend=0)) for x, y in spans], pa.binary()),
        pa.array([_packed(c.links[x:y]) for x, y in spans], pa.binary()), none(pa.list_(pa.int64())), none(pa.list_(pa.int32())),
    ], schema=_ALIGNED_ARROW)
    yield pa.RecordBatch.from_pylist([{"chunk": chunk, "pairs": pairs, "holders": holders.astype(np.int32)}], _ALIGNED_ARROW)


def _aligner(files: Broadcast, chunk_bytes: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _loaded(files)
        chunk = TaskContext.get().partitionId() << 32
        doc_ids, slices, texts, in_chunk, in_slice = [], [], [], 0, 0

        def close_slice() -> None:
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            slices.append(align(tokenizers, np.frombuffer(b"".join(texts), np.uint8), bounds))
            texts.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                raw = (text.as_py() or "").encode()
                if texts and in_slice + len(raw) > slice_bytes:
                    close_slice()
                    in_slice = 0
                if doc_ids and in_chunk + len(raw) > chunk_bytes:
                    if texts:
                        close_slice()
                    yield from _chunk_rows(chunk, doc_ids, slices)
                    doc_ids, slices, in_chunk, in_slice, chunk = [], [], 0, 0, chunk + 1
                doc_ids.append(doc_id.as_py())
                texts.append(raw)
                in_chunk += len(raw)
                in_slice += len(raw)
        if texts:
            close_slice()
        if doc_ids:
            yield from _chunk_rows(chunk, doc_ids, slices)

    return run


def aligned(docs: DataFrame, folder: str = FOLDER, chunk_bytes: int = CHUNK_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """A row per text with its counts and digest, and a row per chunk with its pairs; the two
    vocabulary files (2 MB) go to the executors whole."""
    contents = []
    for name in FILES:
        with open(os.path.join(folder, name), "rb") as file:
            contents.append(file.read())
    context: SparkContext = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_aligner(context.broadcast(tuple(contents)), chunk_bytes, slice_bytes), _ALIGNED)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, documents that hold it, and whether no pair of its A id has more."""
    held = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("documents"))
    # One A id has at most as many pairs as B has ids.
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(of_a))


def _answered(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's texts from the counts of its pairs, in order of pair."""
    order = np.argsort(answers["pair"].to_numpy())
    documents, best = answers["documents"].to_numpy()[order], answers["best"].to_numpy()[order]
    n_best, count_sum = [], []
    for places, links in zip(texts["places"].to_pylist(), texts["links"].to_pylist(), strict=True):
        at, n = np.cumsum(_unpacked(places).astype(np.uint32), dtype=np.uint32), _unpacked(links)
        n_best.append(int(n[best[at]].sum()))
        count_sum.append(int((n * documents[at]).sum()))
    kept = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def alignment_report(docs: DataFrame, folder: str = FOLDER, chunk_bytes: int = CHUNK_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per text: tokens, groups, links, links that are their A id's most widely held, their
    counts' sum over links, and a digest of the groups."""
    rows = stored(aligned(docs, folder, chunk_bytes, slice_bytes), "alignment")
    chunks, texts = rows.where("n_a IS NULL"), rows.where("n_a IS NOT NULL").drop("pairs", "holders")
    counts = stored(pair_counts(chunks), "alignment-counts")
    asked = chunks.select(F.col("chunk").alias("asker"), F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select("asker", "pair", "documents", "best")
    found = texts.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(
        _answered, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

