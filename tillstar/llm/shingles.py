"""Word shingles of many texts at once, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from tillstar.llm.common import mix

_RANDOM = np.random.default_rng(20_240_117)
_LETTER = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * _BASE) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in the slice, and for each text the index of its first word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = space[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    first &= ~space
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lead = starts[0]
    inside = np.arange(lead, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    powers = np.cumprod(np.full(int(inside.max()) + 1, _BASE, np.uint64))
    value = _LETTER[data[lead:]] * powers[inside]
    value[space[lead:]] = 0
    words = mix(np.add.reduceat(value, starts - lead))
    return words, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    Fewer words make one shingle of them all; a text without words has none.
    """
    words, bounds = word_hashes(data, offsets)
    whole = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        whole += words[k : k + len(whole)] * _PLACE[k]
    whole = mix(whole)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        n = high - low
        if n >= size:
            sets.append(np.unique(whole[low : high - size + 1]))
        elif n:
            few = (words[low:high] * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mix(few + _PLACE[size + n : size + n + 1]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
