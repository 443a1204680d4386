"""Texts of Arrow batches as flat byte arrays, and polynomial hashes over them.

A text is hashed from prefix sums: S[i] is the sum of value(byte) * base^i modulo 2^64, so the hash of
any stretch takes two look-ups and one product with the inverse power, whatever its length.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers, and the seed of the values that bytes stand for.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F, 0xAF251AF3B0F025B5)
_VALUES = np.random.Generator(np.random.PCG64(20240613)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` has at most ``limit`` bytes, or a single row."""
    for batch in batches:
        _, at = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(at, at[start] + limit, "right")) - 1, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the entropy of a product over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _powers or len(_powers[which][0]) < n:
        size = 1 << max(n - 1, 1 << 12).bit_length()
        both = []
        for base in (BASES[which], pow(BASES[which], -1, 2**64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _powers[which] = both[0], both[1]
    return _powers[which]


class Hashes:
    """Hashes of all stretches of one flat array."""

    def __init__(self, data: np.ndarray, which: int = 0):
        powers, self.inverse = _tables(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * powers[:len(data)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Of the stretches of this length at every place."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n]

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the given stretches in a row, and for each which stretch it belongs to."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - before[owner] + starts[owner], owner
