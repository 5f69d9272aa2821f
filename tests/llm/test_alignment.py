"""Cross-tokenizer alignment against whole-text encoding and plain loops, and the sparse products."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roadlake.llm import alignment

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    a_file, b_file = (os.path.join(alignment.FOLDER, f) for f in alignment.FILES)
    a = Tokenizer.from_file(a_file)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(c): c for c in printable}
    signs |= {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in printable)}

    def plain(text):
        """Groups of a whole text as lists of (A ids, B ids)."""
        if not text:
            return []
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_parts = [bytes(signs[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a_ids]
        b_parts = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in b_ids for p in [b.id_to_piece(i)]]
        if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            return []
        ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (a_parts, b_parts)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, lows = [], [0, 0]
        for end in common:
            highs = [e.index(end) + 1 for e in ends]
            groups.append((a_ids[lows[0] : highs[0]], b_ids[lows[1] : highs[1]]))
            lows = highs
        return groups

    return plain


def expected_rows(plain, rows):
    groups = [(i, plain(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in groups]
    counts = Counter(pair for held in links for pair in held)
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    for (i, g), held in zip(groups, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(held.values()),
            sum(n for (x, y), n in held.items() if counts[x, y] == highest[x]), sum(n * counts[p] for p, n in held.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        )


def check(plain, docs, **sizes):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.alignment_report(docs, **sizes).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(expected_rows(plain, rows), key=key)


TRICKY = [
    "a b", "a  b", "a   b   c", " a", "a ", " ", "  ", "a\nb c", "a \n b", "it's we'll 'tis x 's", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "é à ü", "日本語 テキスト です", "x y z", "a b", "▁x ▁ y", "tab\tsep a\t b", "\r\n\r\n", "😀 😀😀 👩‍👩‍👧", "́x é", "word" * 300,
    "x" * 5000, "\x00a b", "1 22 333 4444 0x1f", "!!! ??? ... -- a-b_c", "Ａｂｃ ﬁ ½", "﻿bom", "ـــ العربية نص", "हिन्दी पाठ",
]


def test_alignment_of_tricky_texts(spark, both):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)] + [(3, "a b")] * 2, "doc_id long, text string")
    check(both, docs.coalesce(2))
    check(both, docs.coalesce(1), chunk_bytes=64, slice_bytes=16)


def test_alignment_of_the_small_table(spark, both):
    check(both, spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3), chunk_bytes=1 << 16, slice_bytes=1 << 14)


def test_alignment_of_odd_rows(odd_documents, no_documents, both):
    check(both, odd_documents.withColumnRenamed("n", "chunk").withColumnRenamed("size", "pair"))
    assert alignment.alignment_report(no_documents).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_row_products_equal_dense_ones(block):
    rng = np.random.default_rng(3)
    for _ in range(20):
        n, k, m = rng.integers(1, 12, 3)
        left, right = (Counter(zip(rng.integers(0, x, 25).tolist(), rng.integers(0, y, 25).tolist(), strict=True)) for x, y in ((n, k), (k, m)))
        dense = [np.zeros(shape, int) for shape in ((n, k), (k, m))]
        for d, entries in zip(dense, (left, right), strict=True):
            for at, value in entries.items():
                d[at] = value
        made = [
            alignment.Csr.of(np.array([i for i, _ in e.elements()]), np.array([j for _, j in e.elements()]), size, wide)
            for e, size, wide in ((left, n, k), (right, k, m))
        ]
        product = np.zeros((n, m), int)
        for rows, columns, values in alignment.gustavson(*made, block):
            assert (np.diff(rows * m + columns) > 0).all()
            product[rows, columns] = values
        assert (product == dense[0] @ dense[1]).all()


def test_overlaps_share_bytes_and_make_groups():
    a, b = np.array([2, 3, 1, 4]), np.array([1, 4, 2, 1, 2])
    links = [tuple(map(int, x)) for part in alignment.overlap_links(a, b) for x in zip(*part, strict=True)]
    assert links == [(0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 2, 1), (3, 3, 1), (3, 4, 2)]
    groups = alignment.group_of(a, b)
    assert [g.tolist() for g in groups[:2]] == [[0, 0, 1, 1], [0, 0, 1, 1, 1]] and groups[2] == 2


def test_ranks_give_the_library_s_tokens():
    """Every sign that the faster way takes, among letters, digits, marks and spaces."""
    files = [os.path.join(alignment.FOLDER, f) for f in alignment.FILES]
    both = alignment.Tokenizers(*[open(f, "rb").read() for f in files])
    assert both.words_apart and both.ranks_a
    for c in map(chr, range(0x9FA6)):
        if not 0xD800 <= ord(c) < 0xE000 and alignment._usual(c):
            text = f" a{c}1 {c}{c} !{c}?  {c}"
            assert both.ranks_a.encode_ordinary(text) == both.a.encode(text, add_special_tokens=False).ids
