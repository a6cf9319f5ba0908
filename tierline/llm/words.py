"""Words ``[^\\x20\\x09-\\x0D]+`` and 64-bit hashes of byte slices, on whole Arrow batches.

A slice's hash is a polynomial in its bytes modulo 2**64, taken from running sums over the batch,
so no Python object is made per word. Two different words share a hash with odds of 2**-64.
"""

from __future__ import annotations

import numpy as np

from tierline.llm.common import mix64

SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLAIN = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _PLAIN.copy()
_FOLDED[65:91] = _PLAIN[97:123]
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept from one call to the next."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in enumerate((_BASE, inverse)):
            grown = np.full(max(n, SEGMENT + 4096), b, np.uint64)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    return _powers[0], _powers[1]


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """A hash of each byte range, equal for equal bytes wherever they stand. Ranges ascend."""
    out = np.empty(len(starts), np.uint64)
    table = _FOLDED if fold_case else _PLAIN
    a = 0
    while a < len(starts):  # a segment of the batch at a time; it grows only for one longer slice
        base = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        s, e = starts[a:b] - base, ends[a:b] - base
        up, down = _powers_to(int(e[-1]) + 1)
        sums = np.zeros(int(e[-1]) + 1, np.uint64)
        np.cumsum(table[data[base:base + int(e[-1])]] * up[:int(e[-1])], out=sums[1:])
        out[a:b] = (sums[e] - sums[s]) * down[s]
        a = b
    return mix64(out ^ (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per document where its words begin (n+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a document begins here
    cut[offsets] = True
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | cut[1:-1]
    ends = ink
    ends[:-1] &= ~ink[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with A-Z lower-cased, and per document where its words begin (n+1)."""
    starts, ends, first = word_spans(data, offsets)
    return slice_hashes(data, starts, ends, fold_case=True), first
