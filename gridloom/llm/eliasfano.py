"""Elias-Fano coding of non-decreasing integer sequences.

n values below u take about n * (2 + log2(u / n)) bits: the low bits of each value
are packed as they are, the high parts go as unary gaps into a bit vector.  The place of every
SAMPLE-th set bit is stored with them (32 bits for SAMPLE values), so that ``select`` finds a
value by a scan over the bits between two samples; no table of 64-bit values is made.
"""

from __future__ import annotations

import struct

import numpy as np

#: values, bytes of high parts, low bits of a value
_HEAD = struct.Struct("<QQB")
#: One place is kept for so many set bits.
SAMPLE = 256


def encode(values: np.ndarray) -> bytes:
    """Header, samples (u32), high parts, low parts.  High parts take less than 2**32 bits (some billion values)."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low = max(0, (top // max(1, n)).bit_length() - 1) if n else 0
    high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros((int(high[-1]) + 8) // 8 * 8 if n else 0, np.uint8)
    bits[high] = 1
    lows = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    pack = lambda b: np.packbits(b, bitorder="little").tobytes()
    return _HEAD.pack(n, len(bits) // 8, low) + high[::SAMPLE].astype("<u4").tobytes() + pack(bits) + pack(lows)


class Sequence:
    """A view of an encoded sequence; nothing is decoded before it is asked for."""

    def __init__(self, blob: bytes | memoryview):
        self.n, nbytes, self.low = _HEAD.unpack_from(blob, 0)
        raw = np.frombuffer(blob, np.uint8)
        samples = _HEAD.size + -(-self.n // SAMPLE) * 4
        self.samples = raw[_HEAD.size:samples].view("<u4")
        self.upper, self.lower = raw[samples:samples + nbytes], raw[samples + nbytes:]

    def __len__(self) -> int:
        return self.n

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` .. ``last`` - 1."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last))
        if first == last:
            return np.zeros(0, np.int64)
        # set bits from the sample before the first value to the one behind the last
        begin, stop = first // SAMPLE, -(-last // SAMPLE)
        byte = int(self.samples[begin]) >> 3
        end = (int(self.samples[stop]) >> 3) + 1 if stop < len(self.samples) else len(self.upper)
        places = np.flatnonzero(np.unpackbits(self.upper[byte:end], bitorder="little")) + byte * 8
        skip = int(np.searchsorted(places, int(self.samples[begin]))) + first - begin * SAMPLE
        i = np.arange(first, last)
        high = places[skip:skip + last - first] - i
        if not self.low:
            return high
        at = first * self.low
        bits = np.unpackbits(self.lower[at >> 3:(last * self.low + 7) >> 3], bitorder="little")[at & 7:]
        bits = bits[:(last - first) * self.low].reshape(-1, self.low).astype(np.int64)
        return (high << self.low) + (bits << np.arange(self.low)).sum(axis=1)

    def __getitem__(self, i: int) -> int:
        return int(self.select(i, i + 1)[0])
