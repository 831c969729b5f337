"""Content-defined positions: equal windows of two texts hold equal positions at equal places."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Documents whose hashes a task holds at a time.
AT_ONCE = 1000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of bounded length."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(start, AT_ONCE)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, in order, element by element."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x165667B19E3779F9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _sliding(pick: Callable, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values, size = pick(values[:-size], values[size:]), 2 * size
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors_of(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all windows of ``width`` values, and the first and last window of each.

    The anchor of a window is the position of its smallest value, the leftmost of equals; every
    window has one, and the windows of one anchor follow each other.
    """
    if len(values) < width:
        return (np.empty(0, np.int64),) * 3
    minima = _sliding(np.minimum, values, width)
    least = np.zeros(len(values) + width - 1, np.uint64)
    least[width - 1 : len(values)] = minima
    found = np.flatnonzero(_sliding(np.maximum, least, width) == values)
    own = np.searchsorted(found, np.arange(len(minima)))
    wrong = np.flatnonzero(values[found[own]] != minima)
    while len(wrong):
        own[wrong] += 1
        wrong = wrong[values[found[own[wrong]]] != minima[wrong]]
    used, first = np.unique(own, return_index=True)
    return found[used], first, np.append(first[1:], len(minima)) - 1


def shapes(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where an anchor's windows begin and how many follow, relative to the anchor, in one number."""
    return (at - first) << 16 | (last - first)


def merge_runs(packed: np.ndarray) -> np.ndarray:
    """Union of half-open runs; each is start * 2**32 + end, sorted or not, and so is the result."""
    packed = np.sort(np.asarray(packed, np.int64))
    if not len(packed):
        return packed
    starts, ends = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF)
    first = np.ones(len(packed), bool)
    first[1:] = starts[1:] > ends[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(packed)) - 1
    return (starts[at] << 32) | ends[last]
