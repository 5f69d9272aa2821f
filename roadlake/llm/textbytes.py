"""Words, lines and their 64-bit hashes over whole Arrow text columns, without a Python loop per row.

A slice is a run of neighbouring texts of about SLICE_BYTES (one longer text is a slice of
its own), so memory follows the slice and the longest text, never the batch.

The hash of a byte string is a polynomial over random byte values modulo 2^64, taken from
prefix sums and then mixed; equal strings have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# A power is one of these times one of base^PAGE: tables stay small however long a text is.
PAGE = 1 << 16

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def byte_class(*excluded: tuple[int, int]) -> np.ndarray:
    """True for each byte outside the given closed ranges."""
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


# [^\x20\x09-\x0D]+ and, after lower-casing A-Z, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def page_powers(base: int, n: int) -> np.ndarray:
    """The power at the start of each page of n positions."""
    return powers(pow(base, PAGE, 1 << 64), -(-n // PAGE))


_IN_PAGE = powers(_BASE, PAGE)
_IN_PAGE_INVERSE = powers(_BASE_INVERSE, PAGE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


@dataclass
class Slice:
    first: int  # index of the first text in the array
    data: np.ndarray  # its bytes
    bounds: np.ndarray  # len(texts) + 1 offsets into data

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def prefix(self) -> np.ndarray:
        terms = _BYTE_VALUES[self.data]
        for k, start in enumerate(page_powers(_BASE, len(terms))):
            page = terms[k * PAGE : (k + 1) * PAGE]
            page *= _IN_PAGE[: len(page)]
            page *= start
        sums = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        return sums

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1


def hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h = prefix[ends] - prefix[starts]
    h *= _IN_PAGE_INVERSE[starts & (PAGE - 1)]
    h *= page_powers(_BASE_INVERSE, len(prefix))[starts >> PAGE.bit_length() - 1]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def slices(texts: pa.Array, limit: int = SLICE_BYTES, lower: bool = False) -> Iterator[Slice]:
    """Slices of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = data[offsets[first] : offsets[last]]
        yield Slice(first, LOWER_AZ[part] if lower else part, offsets[first : last + 1] - offsets[first])
        first = last
    # Workers are kept between stages: what Arrow holds for batches that are done goes back.
    pa.default_memory_pool().release_unused()


def word_spans(s: Slice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and counts per text; words never cross texts."""
    inside = table[s.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    cuts = s.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, s.bounds))


