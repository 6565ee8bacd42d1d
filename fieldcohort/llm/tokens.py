"""Words of whole Arrow batches as 64-bit hashes, computed on the bytes with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and return. UTF-8 never uses those bytes inside another character.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WRAP = (1 << 64) - 1


def _stream(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers (a counter through a bit mixer)."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective bit mixer over uint64."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE = _stream(1, 256)
STEP = np.uint64(0x9FB21C651E98DF25)
PLACE = _stream(2, 64) | np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first): where runs of True begin, cut at the offsets, and the first run of each row."""
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(inside)]
    begin[edges] |= inside[edges]
    starts = np.flatnonzero(begin)
    return starts, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the bytes inside each run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    data, inside, starts = data[starts[0] :], inside[starts[0] :], starts - starts[0]
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(starts, np.diff(starts, append=len(data)))
    powers = np.full(int(place.max()) + 1, STEP, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    value = BYTE[data]
    value *= powers[place]
    value *= inside
    return mix(np.add.reduceat(value, starts))


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): one hash per word; words of row i are first[i] to first[i + 1]."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~IS_SPACE[data]
    starts, first = runs(inside, offsets)
    return run_hashes(data, inside, starts), first


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of ``size`` consecutive words, whatever rows they lie in."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total += hashes[j : j + count] * PLACE[j]
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5):
    """For each row its sorted distinct shingles of ``size`` words.

    A row with fewer words has its whole sequence as the one shingle, a row
    without words none.
    """
    hashes, first = word_hashes(texts)
    every = windows(hashes, size)
    for low, high in zip(first[:-1], first[1:]):
        if high - low >= size:
            yield np.unique(every[low : high - size + 1])
        elif high > low:
            yield mix((hashes[low:high] * PLACE[size + 1 : size + 1 + high - low]).sum(keepdims=True))
        else:
            yield every[:0]
