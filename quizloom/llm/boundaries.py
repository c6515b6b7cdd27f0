"""A set of text positions in containers, as Roaring bitmaps have them.

Positions are split into a container number (the upper bits) and the lower 16 bits.
Each container keeps its members in whichever of three forms is smallest: a sorted
array, a bitmap, or runs of neighbours. Cumulative cardinalities over the containers
tell where the k-th member is, and a select inside that container finds it.
"""

import numpy as np

CONTAINER_BITS = 16
CONTAINER = 1 << CONTAINER_BITS


class ArrayContainer:
    """Sorted members; two bytes each."""

    def __init__(self, members: np.ndarray):
        self._members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self._members[k])


class BitmapContainer:
    """One bit per possible member; running counts per word lead to a member's word."""

    def __init__(self, members: np.ndarray):
        bits = np.zeros(CONTAINER, dtype=bool)
        bits[members] = True
        self._words = np.packbits(bits, bitorder="little").view("<u8")
        self._upto = np.cumsum(np.bitwise_count(self._words), dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self._upto, k, side="right"))
        word = int(self._words[at])
        for _ in range(k - (int(self._upto[at - 1]) if at else 0)):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of runs of neighbours with the members up to each run's end."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self._starts = starts.astype(np.uint16)
        self._upto = np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self._upto, k, side="right"))
        return int(self._starts[run]) + k - (int(self._upto[run - 1]) if run else 0)


def container(members: np.ndarray):
    """The smallest container of the sorted ``members`` of 0..65535; there is at least one."""
    first = np.flatnonzero(np.diff(members, prepend=-2) != 1)
    sizes = {
        ArrayContainer: 2 * len(members),
        BitmapContainer: CONTAINER // 8,
        RunContainer: 4 * len(first),
    }
    kind = min(sizes, key=sizes.get)
    if kind is RunContainer:
        return RunContainer(members[first], np.diff(np.append(first, len(members))))
    return kind(members)


class BoundarySet:
    """Ends of a text's units, added container by container in rising order."""

    def __init__(self):
        self._keys: list[int] = []
        self._containers: list = []
        # Members up to the end of each container.
        self._upto: list[int] = []

    def add(self, key: int, members: np.ndarray) -> None:
        """The members of container ``key``, which is above all earlier ones."""
        if len(members):
            self._upto.append(len(self) + len(members))
            self._keys.append(key)
            self._containers.append(container(members))

    def __len__(self) -> int:
        return self._upto[-1] if self._upto else 0

    def select(self, k: int) -> int:
        """The k-th smallest member, counted from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self._upto, k, side="right"))
        before = self._upto[at - 1] if at else 0
        return (self._keys[at] << CONTAINER_BITS) + self._containers[at].select(k - before)
