"""Hashes of words and word shingles for a whole Arrow batch at once.

Words are maximal runs of bytes other than space and 0x09-0x0D after lower-casing A-Z. All
hashes are 64 bits wide; within one document two different shingles collide with a
probability below n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sieveline.llm.common import byte_offsets

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OF_BYTE = _RANDOM[_LOWER]  # a random number for each byte, the same for both cases
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, U)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and at which word each text starts (one more than texts)."""
    data, offsets = byte_offsets(texts)
    n = len(data)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = _WORD[data]
    # A text's end also ends a word.
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]]) if len(cuts) else cuts
    if len(cuts):
        starts = np.union1d(starts, cuts)
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if len(cuts):
        ends = np.union1d(ends, cuts)
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum(_OF_BYTE[data] * up[:n], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
    return words, np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of ``width`` words, in text order with repeats, and where each text starts.

    A text with fewer words, but one at least, has the whole sequence as its only shingle.
    """
    words, first = word_hashes(texts)
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    starts = np.concatenate([[0], np.cumsum(made)])
    if not starts[-1]:
        return np.zeros(0, U), starts
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], made) + np.repeat(first[:-1], made)
    left = np.repeat(np.minimum(counts, width), made)
    out = np.zeros(len(at), U)
    for k in range(width):
        here = words[np.minimum(at + k, len(words) - 1)]
        out = np.where(left > k, mix(out * U(0x2545F4914F6CDD1D) + here), out)
    return out, starts


def distinct_by_text(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and where each text starts."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return (np.concatenate(parts) if parts else hashes), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
