"""A monotone sequence of integers in near-minimal space, with select.

A value is split into ``low`` bits, stored packed, and its high part, stored in unary: bit
``high + k`` is set for the k-th value. With n values below u, low = floor(log2(u / n)),
so the whole takes about 2 + log2(u / n) bits a value, and no table of 64-bit numbers
exists. ``select(k)`` needs the place of the k-th set bit: a sample is kept for every
256th, and from there whole bytes are skipped by their bit counts.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = struct.Struct("<QQBQQ")  # values, smallest value, low bits, bytes of the packed low part, bytes of the unary part
_COUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


class EliasFano:
    def __init__(self, n: int, least: int, low: int, packed: np.ndarray, unary: np.ndarray, samples: np.ndarray):
        self.n, self.least, self.low = n, least, low
        self.packed, self.unary, self.samples = packed, unary, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: non-decreasing integers of any sign."""
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        if n == 0:
            none = np.zeros(0, np.uint8)
            return cls(0, 0, 0, none, none, np.zeros(0, np.uint32))
        least = int(values[0])
        offset = (values - least).astype(np.uint64)
        top = int(offset[-1])
        low = max(0, (top // n).bit_length() - 1) if top >= n else 0
        bits = (offset[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (offset >> np.uint64(low)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(places[-1]) + 1, np.uint8)
        marks[places] = 1
        return cls(n, least, low, packed, np.packbits(marks, bitorder="little"), places[::STEP].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.least & (2**64 - 1), self.low, len(self.packed), len(self.unary))
        return head + self.packed.tobytes() + self.unary.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence stored at ``at``, and where its bytes end."""
        n, least, low, n_packed, n_unary = _HEAD.unpack_from(data, at)
        least = least - 2**64 if least >= 2**63 else least
        at += _HEAD.size
        packed = np.frombuffer(data, np.uint8, n_packed, at)
        unary = np.frombuffer(data, np.uint8, n_unary, at + n_packed)
        at += n_packed + n_unary
        n_samples = -(-n // STEP)
        return cls(n, least, low, packed, unary, np.frombuffer(data, "<u4", n_samples, at)), at + 4 * n_samples

    def _low(self, first: int, stop: int) -> np.ndarray:
        if not self.low:
            return np.zeros(stop - first, np.int64)
        start, end = first * self.low, stop * self.low
        bits = np.unpackbits(self.packed[start // 8 : -(-end // 8)], bitorder="little")[start % 8 :][: end - start]
        weights = np.left_shift(np.int64(1), np.arange(self.low, dtype=np.int64))
        return bits.reshape(-1, self.low).astype(np.int64) @ weights

    def select(self, k: int) -> int:
        """The k-th value, counted from 0."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        place = int(self.samples[k // STEP])
        missing = k % STEP
        byte = place // 8
        here = int(self.unary[byte]) >> (place % 8) << (place % 8)  # the sampled bit and those after it
        while missing >= (count := int(_COUNT[here])):
            missing -= count
            byte += 1
            here = int(self.unary[byte])
        for _ in range(missing):
            here &= here - 1
        place = 8 * byte + (here & -here).bit_length() - 1
        return self.least + ((place - k) << self.low) + int(self._low(k, k + 1)[0])

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.unary, bitorder="little"))
        return self.least + ((places - np.arange(self.n)) << self.low) + self._low(0, self.n)

    def first_at_least(self, value: int) -> int:
        """The smallest k whose value is not below ``value``; n if there is none."""
        first, stop = 0, self.n
        while first < stop:
            middle = (first + stop) // 2
            if self.select(middle) < value:
                first = middle + 1
            else:
                stop = middle
        return first

    def n_bytes(self) -> int:
        return len(self.to_bytes())
