"""A compressed set of offsets, after Roaring bitmaps, that answers rank and select.

Offsets are grouped by their upper bits; the lower 16 bits of a group lie in one container: a sorted
array, a bitmap of 65 536 bits, or a list of runs, whichever is smallest. The cardinalities of the
containers are kept added up, so that the k-th offset is one binary search for its container and one
search inside it, without unpacking anything.
"""

from __future__ import annotations

import numpy as np

WIDTH = 1 << 16
WORDS = WIDTH // 64


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, value: int) -> int:
        return int(np.searchsorted(self.low, value))


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(WIDTH, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return WIDTH // 8

    def _word(self, i: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words[i : i + 1].view(np.uint8), bitorder="little"))

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return 64 * i + int(self._word(i)[k - self.before[i]])

    def rank(self, value: int) -> int:
        if value >= WIDTH:
            return int(self.before[-1])
        i = value // 64
        return int(self.before[i]) + int(np.searchsorted(self._word(i), value % 64))


class RunContainer:
    def __init__(self, low: np.ndarray):
        new = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.first = low[new].astype(np.uint16)
        self.before = np.append(new, len(low)).astype(np.int64)

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 2 + 4 * runs

    def select(self, k: int) -> int:
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[i]) + k - int(self.before[i])

    def rank(self, value: int) -> int:
        i = int(np.searchsorted(self.first, value, "right")) - 1
        if i < 0:
            return 0
        return min(int(self.before[i]) + value - int(self.first[i]), int(self.before[i + 1]))


KINDS = (ArrayContainer, RunContainer, BitmapContainer)


class BoundarySet:
    """Built from offsets that rise strictly, none of them negative; an empty set is allowed."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, np.int64)
        upper = offsets // WIDTH
        starts = np.flatnonzero(np.diff(upper, prepend=-1))
        self.keys = upper[starts]
        self.before = np.append(starts, len(offsets)).astype(np.int64)
        self.containers = []
        for a, b in zip(self.before, self.before[1:], strict=False):
            low = offsets[a:b] % WIDTH
            runs = int(np.count_nonzero(np.diff(low, prepend=-2) != 1))
            self.containers.append(min(KINDS, key=lambda c: c.size(low, runs))(low))  # noqa: B023

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.keys[i]) * WIDTH + self.containers[i].select(k - int(self.before[i]))

    def rank(self, value: int) -> int:
        """How many offsets are smaller."""
        key, low = divmod(value, WIDTH)
        i = int(np.searchsorted(self.keys, key))
        inside = self.containers[i].rank(low) if i < len(self.keys) and self.keys[i] == key else 0
        return int(self.before[i]) + inside
