"""Elias-Fano coding of ascending integers with a select structure."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<4sQQBI")
_MAGIC = b"EF01"
#: Every so many values, the place of the value's bit in the upper part is kept.
SAMPLE = 256


class EliasFano:
    """Ascending integers (repeats allowed) in about 2 + log2(largest / count) bits each.

    The low bits of a value stand side by side; the rest is a unary bit vector, in which value i is bit number
    (value >> low) + i. ``select`` reads one value, from the nearest sampled place on, and ``select_range`` some that stand together.
    """

    def __init__(self, count: int, top: int, low: int, lows: np.ndarray, upper: np.ndarray, samples: np.ndarray):
        self.count, self.top, self.low = count, top, low
        self._lows, self._upper, self._samples = lows, upper, samples

    @classmethod
    def of(cls, values) -> EliasFano:
        values = np.asarray(values, np.uint64)
        if len(values) and (np.diff(values.astype(np.int64)) < 0).any():
            raise ValueError("values must ascend")
        count, top = len(values), int(values[-1]) if len(values) else 0
        low = max(0, (top // count).bit_length() - 1) if count else 0
        shifts = np.arange(low, dtype=np.uint64)
        lows = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little")
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(count)
        bits = np.zeros(int(places[-1]) + 1 if count else 0, np.uint8)
        bits[places] = 1
        return cls(count, top, low, lows, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        return _HEAD.pack(_MAGIC, self.count, self.top, self.low, len(self._upper)) + self._lows.tobytes() + self._upper.tobytes() + self._samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        magic, count, top, low, upper = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("no Elias-Fano data")
        at = _HEAD.size
        lows = np.frombuffer(data, np.uint8, (count * low + 7) // 8, at)
        high = np.frombuffer(data, np.uint8, upper, at + len(lows))
        samples = np.frombuffer(data, "<u4", -(-count // SAMPLE), at + len(lows) + upper)
        return cls(count, top, low, lows, high, samples)

    def _low_of(self, i: int) -> int:
        start = i * self.low
        some = self._lows[start >> 3 : (start + self.low + 7) >> 3]
        return (int.from_bytes(some.tobytes(), "little") >> (start & 7)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Value number i, by reading a bounded run of bits around it."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        place, missing = int(self._samples[i // SAMPLE]), i % SAMPLE
        while True:
            # Set bits from the sampled place on, some bytes at a time.
            some = self._upper[place >> 3 : (place >> 3) + 64]
            found = np.flatnonzero(np.unpackbits(some, bitorder="little")[place & 7 :])
            if missing < len(found):
                return ((place + int(found[missing]) - i) << self.low) | self._low_of(i)
            missing -= len(found)
            place = ((place >> 3) + 64) << 3

    def select_range(self, first: int, stop: int) -> np.ndarray:
        """Values number ``first`` to ``stop`` - 1, by reading the bits from the sampled place before them to the one after."""
        if not 0 <= first <= stop <= self.count:
            raise IndexError((first, stop))
        if first == stop:
            return np.zeros(0, np.uint64)
        after = -(-stop // SAMPLE)
        begin = int(self._samples[first // SAMPLE])
        end = int(self._samples[after]) if after < len(self._samples) else 8 * len(self._upper)
        base = begin >> 3 << 3
        places = base + np.flatnonzero(np.unpackbits(self._upper[base >> 3 : (end + 7) >> 3], bitorder="little"))
        places = places[np.searchsorted(places, begin) :][first % SAMPLE : first % SAMPLE + stop - first]
        high = (places - np.arange(first, stop)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        start, last = first * self.low, stop * self.low
        bits = np.unpackbits(self._lows[start >> 3 : (last + 7) >> 3], bitorder="little")[start & 7 :][: last - start].reshape(-1, self.low)
        return high | (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def values(self) -> np.ndarray:
        """All values, ascending."""
        return self.select_range(0, self.count)
