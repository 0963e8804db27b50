"""Elias-Fano coding of ascending integers: about 2 + log2(universe / n) bits for each, with select."""

from __future__ import annotations

import struct

import numpy as np

#: Ones between two entries of the select directory.
SAMPLE = 256
_HEAD = struct.Struct("<QQQqB")


class EliasFano:
    """n ascending integers less ``base``. The upper bits are a unary bit vector, the low ones packed.

    Value i has its upper part's one at place (value >> low_bits) + i, so that the
    value is select(i) - i, and the low bits. The directory holds the place of every
    SAMPLE-th one.
    """

    def __init__(self, n: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.n, self.base, self.low_bits, self.low, self.high, self.places = n, base, low_bits, low, high, places

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if n == 0:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        base = int(values[0])
        rest = values.view(np.uint64) - np.uint64(base & (1 << 64) - 1)
        if (rest[1:] < rest[:-1]).any() or (values[1:] < values[:-1]).any():
            raise ValueError("values must ascend")
        span = int(rest[-1]) + 1
        low_bits = max(0, (span // n).bit_length() - 1)
        if low_bits:
            bits = (rest[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(-(-(int(ones[-1]) + 1) // 64) * 64, np.uint8)
        high[ones] = 1
        return cls(n, base, low_bits, low, np.packbits(high, bitorder="little").view(np.uint64), ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, len(self.low), len(self.high), self.base, self.low_bits)
        return head + self.high.tobytes() + self.places.tobytes() + self.low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, n_low, n_high, base, low_bits = _HEAD.unpack_from(data)
        high = np.frombuffer(data, np.uint64, n_high, _HEAD.size)
        places = np.frombuffer(data, np.uint64, -(-n // SAMPLE), _HEAD.size + 8 * n_high)
        return cls(n, base, low_bits, np.frombuffer(data, np.uint8, n_low, _HEAD.size + 8 * (n_high + len(places))), high, places)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def _value(self, place: np.ndarray, i: np.ndarray) -> np.ndarray:
        upper = (place - i).astype(np.uint64) << np.uint64(self.low_bits)
        return ((upper | self._lows(i)) + np.uint64(self.base & (1 << 64) - 1)).view(np.int64)

    def select(self, i: int) -> int:
        """The place of the i-th one: from the directory's entry on, word by word."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.places[i // SAMPLE])
        need = i % SAMPLE
        word, bits = place >> 6, int(self.high[place >> 6]) >> (place & 63) << (place & 63)
        while (ones := bits.bit_count()) <= need:
            need -= ones
            word += 1
            bits = int(self.high[word])
        for _ in range(need):
            bits &= bits - 1
        return word * 64 + (bits & -bits).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        return int(self._value(np.array([self.select(i)]), np.array([i]))[0])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Values start to stop - 1: one select, then the ones after it in order."""
        stop = min(stop, self.n)
        if start >= stop:
            return np.zeros(0, np.int64)
        first, last = self.select(start), self.select(stop - 1)
        bits = np.unpackbits(self.high[first >> 6 : (last >> 6) + 1].view(np.uint8), bitorder="little")
        ones = np.nonzero(bits)[0] + (first >> 6 << 6)
        ones = ones[(ones >= first) & (ones <= last)]
        return self._value(ones, np.arange(start, stop))
