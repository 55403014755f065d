"""Vectorised tokens of Arrow text columns: words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random 64-bit value for each byte, nothing for white space, so that sums over words may run on through the spaces.
_VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[SPACE] = 0
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and len + 1 offsets into them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def runs(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes in all; a longer row stands alone."""
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of several texts: starts and ends in `low` (lower-cased bytes); first[k]:first[k+1] are those of text k."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.low = LOWER[data]
        inside = ~SPACE[data]
        before = np.empty_like(inside)
        if len(inside):
            before[0] = False
            before[1:] = inside[:-1]
            before[at[:-1][at[:-1] < len(inside)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        if len(inside):
            after[-1] = False
            after[:-1] = inside[1:]
            last = at[1:] - 1
            after[last[(last >= 0) & (at[1:] > at[:-1])]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, at)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word (signed view for Spark)."""
        if not len(self.starts):
            return np.zeros(0, np.int64)
        power, inverse = _power_tables(len(self.low))
        h = np.add.reduceat(_VALUE[self.low] * power[: len(self.low)], self.starts) * inverse[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64)).view(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices starts[k] .. starts[k] + lengths[k] - 1, one after the other."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
