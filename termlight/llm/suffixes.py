"""Suffix arrays of a shard of texts in numpy, with common prefixes."""

from __future__ import annotations

import numpy as np


class Shard:
    """Texts laid one after the other; ``rest`` is the number of bytes from a position to its text's end."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.bytes = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        self.text_of = np.repeat(np.arange(len(texts)), sizes)
        self.rest = self.ends[self.text_of] - np.arange(int(sizes.sum()))

    def suffix_array(self) -> np.ndarray:
        """Larsson-Sadakane refinement: start from the first eight bytes, then double the depth and
        sort again only the groups that are still tied, by the group of what follows.

        Suffixes end with their text; equal whole suffixes stay in the order of their positions.
        """
        n = len(self.rest)
        # Big-endian values order like the bytes; bytes beyond a text's end are masked.
        head = np.ndarray((n,), ">u8", self.bytes, strides=(1,)).astype(np.uint64)
        short = np.maximum(8 - self.rest, 0).astype(np.uint64) * np.uint64(8)
        head = np.where(short > 0, (head >> short) << short, head)
        order = np.lexsort((np.minimum(self.rest, 8), head))
        group = np.empty(n, np.int64)
        keys = np.stack([head[order].view(np.int64), np.minimum(self.rest, 8)[order]])
        group[order] = self._numbers((np.diff(keys) != 0).any(axis=0))
        depth, longest = 8, int(self.rest.max(initial=0))
        while depth < longest:
            sizes = np.bincount(group, minlength=n)
            tied = np.flatnonzero(sizes[group[order]] > 1)
            if not len(tied):
                break
            at = order[tied]
            follows = np.where(self.rest[at] > depth, group[np.minimum(at + depth, n - 1)] + 1, 0)
            keys = group[at] * (n + 1) + follows
            by = np.argsort(keys, kind="stable")
            order[tied], keys = at[by], keys[by]
            new = np.ones(len(tied), bool)
            new[1:] = keys[1:] != keys[:-1]
            group[order[tied]] = np.maximum.accumulate(np.where(new, tied, 0))
            depth *= 2
        return order

    @staticmethod
    def _numbers(changes: np.ndarray) -> np.ndarray:
        """A group is known by the place of its first member."""
        first = np.concatenate([[True], changes])
        return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))

    def common_prefixes(self, order: np.ndarray, most: int) -> np.ndarray:
        """Kasai's common prefixes with the suffix before, up to ``most``, for all texts in step."""
        n = len(order)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        shared, lengths = np.zeros(n, np.int64), self.ends - self.starts
        texts, held = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        for step in range(int(lengths.max(initial=0))):
            inside = lengths[texts] > step
            texts, held = texts[inside], held[inside]
            at = self.starts[texts] + step
            before = order[np.maximum(place[at] - 1, 0)]
            limit = np.where(place[at] > 0, np.minimum(np.minimum(self.rest[at], self.rest[before]), most), 0)
            held = np.minimum(np.maximum(held - 1, 0), limit)
            going = np.flatnonzero(held < limit)
            while len(going):
                equal = self.bytes[at[going] + held[going]] == self.bytes[before[going] + held[going]]
                going = going[equal]
                held[going] += 1
                going = going[held[going] < limit[going]]
            shared[place[at]] = held
        return shared


def repeated_starts(shard: Shard, length: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions with ``length`` bytes left, whether these stand at another place, and their group.

    ``place`` names the place of each position; one place may be in several texts of a shard. Equal
    strings have equal groups, which ascend in the order of the strings.
    """
    order = shard.suffix_array()
    shared = shard.common_prefixes(order, length)
    group = np.cumsum(shared < length)
    whole = shard.rest[order] >= length
    order, group = order[whole], group[whole]
    if not len(order):
        return order, np.zeros(0, bool), group
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    places = place[order]
    several = np.minimum.reduceat(places, first) != np.maximum.reduceat(places, first)
    return order, np.repeat(several, np.diff(np.append(first, len(order)))), group
