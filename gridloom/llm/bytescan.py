"""Vectorised scans over the UTF-8 bytes of Arrow text columns.

Used inside ``mapInArrow`` tasks.  Texts of one slice lie end to end in one byte
array with an offset table; no helper here lets a word or window cross a text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Scans take some hundred bytes of memory for each byte of a slice.
SLICE_BYTES = 512 << 10
_ROWS = 1024


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes.

    Null texts count as empty; a longer text forms a slice of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for base in range(0, len(column), _ROWS):
        # a window of rows at a time, so that no second copy of a whole batch is held
        part = column.slice(base, _ROWS).cast(pa.large_string()).fill_null("")
        n = len(part)
        _, offs, data = part.buffers()
        offsets = np.frombuffer(offs, np.int64, n + 1, part.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        row = 0
        while row < n:
            end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            end = min(n, max(row + 1, end))
            yield base + row, base + end, raw[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
            row = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_kept_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for at least ``n`` places."""
    if _kept_powers and len(_kept_powers[0][0]) >= n:
        return _kept_powers[0]
    size, r = -(-n // 65536) * 65536, 0x9E3779B97F4A7C15
    up, down = np.full(size, r, np.uint64), np.full(size, pow(r, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    made = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    if size <= 1 << 21:  # those of a longer text are not kept
        _kept_powers[:] = [made]
    return made


@functools.lru_cache(maxsize=4)
def byte_values(fold_case: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def running_hash(data: np.ndarray, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash and the factors that move a difference to place 0."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values(fold_case)[data] * up[:len(data)], out=sums[1:])
    return sums, down


@functools.lru_cache(maxsize=4)
def word_bytes(kind: str) -> np.ndarray:
    """Which bytes belong to words: ``blank`` splits at ASCII white space only, ``alnum``
    keeps ASCII letters, digits and every byte of non-ASCII characters."""
    table = np.zeros(256, bool)
    if kind == "blank":
        table[:] = True
        table[[0x20, 9, 10, 11, 12, 13]] = False
    else:
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
            table[low:high + 1] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    inside = word_bytes(kind)[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, A-Z folded to a-z."""
    sums, down = running_hash(data, True)
    return mix64((sums[ends] - sums[starts]) * down[starts])


def ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges begins[i] .. begins[i] + lengths[i]."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(begins - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift
