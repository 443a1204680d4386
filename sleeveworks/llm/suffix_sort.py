"""Sorting suffixes whose comparisons are hash look-ups.

The common extension of two suffixes is found by binary search over prefix polynomial hashes, so a
comparison takes the logarithm of its length. A mergesort over them runs on all groups at once: at
each level every suffix finds its rank in the neighbouring run by binary search. The order and the
common extensions of neighbours are then verified byte by byte; if a hash collision misled the sort,
it is repeated with another base.
"""

import numpy as np

from sleeveworks.llm.flatbytes import BASES, Hashes, ranges


class _Suffixes:
    """Suffixes of a flat array, each cut off after a length."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, which: int):
        self.data, self.start, self.length = data, start, length
        self.hashes = Hashes(data, which)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, by binary search."""
        x, y = self.start[a], self.start[b]
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.length[a], self.length[b])
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.hashes.at(x, middle) == self.hashes.at(y, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, np.minimum(middle - 1, high))
            high = np.maximum(high, low)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before b; the end of a suffix comes before any byte."""
        n = self.common(a, b)
        end_a, end_b = n >= self.length[a], n >= self.length[b]
        top = len(self.data) - 1
        byte_a = self.data[np.minimum(self.start[a] + n, top)]
        byte_b = self.data[np.minimum(self.start[b] + n, top)]
        return np.where(end_a, ~end_b | or_equal, ~end_b & (byte_a < byte_b))

    def verified(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
        """Whether n is the common extension of neighbours a, b and a doesn't come after b."""
        places, owner = ranges(self.start[a], n)
        if not np.array_equal(self.data[places], self.data[places - self.start[a][owner] + self.start[b][owner]]):
            return False
        open_a, open_b = n < self.length[a], n < self.length[b]
        both = open_a & open_b
        right = self.data[self.start[a[both]] + n[both]] < self.data[self.start[b[both]] + n[both]]
        return bool(right.all() and not (open_a & ~open_b).any())


def sort_suffixes(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes within their groups, and the common extension of each with the one before.

    ``group`` must not decrease. The first of a group has an extension of -1.
    """
    for which in range(len(BASES)):
        suffixes = _Suffixes(data, start, length, which)
        order = _merge_sort(suffixes, group)
        extension = np.full(len(order), -1, np.int64)
        inside = np.flatnonzero(group[1:] == group[:-1]) + 1
        a, b = order[inside - 1], order[inside]
        extension[inside] = suffixes.common(a, b)
        if suffixes.verified(a, b, extension[inside]):
            return order, extension
    raise ArithmeticError("hash collisions under every base")


def _merge_sort(suffixes: _Suffixes, group: np.ndarray) -> np.ndarray:
    n = len(group)
    order = np.arange(n)
    if n == 0:
        return order
    first = np.searchsorted(group, group, "left")
    size = np.searchsorted(group, group, "right") - first
    rank = order - first
    width = 1
    while width < int(size.max()):
        run = rank // width
        other = (run ^ 1) * width
        moving = np.flatnonzero(other < size)
        base, left = first[moving], (run[moving] & 1) == 0
        low = base + other[moving]
        high = np.minimum(low + width, base + size[moving])
        begin, own = low.copy(), order[moving]
        for _ in range(width.bit_length()):
            searching = low < high
            if not searching.any():
                break
            middle = np.minimum((low + high) >> 1, n - 1)
            # Equal suffixes keep their order: those of the left run come first.
            ahead = suffixes.less(order[middle], own, ~left)
            low = np.where(searching & ahead, middle + 1, low)
            high = np.where(searching & ~ahead, middle, high)
        pair = base + (run[moving] & ~1) * width
        target = pair + (rank[moving] % width) + (low - begin)
        merged = order.copy()
        merged[target] = own
        order = merged
        width *= 2
    return order
