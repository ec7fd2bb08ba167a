"""Character n-grams of the words of many texts at once, as hashed slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Letters lower-cased, bytes of other scripts as they are, all else one separator (0).
_WORD = np.zeros(256, np.uint8)
_WORD[97:123] = np.arange(97, 123)
_WORD[65:91] = np.arange(97, 123)
_WORD[128:] = np.arange(128, 256)


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bytes with a separator before every text and eight at the end, and the new starts."""
    n = len(offsets) - 1
    out = np.zeros(len(data) + n + 8, np.uint8)
    owner = np.repeat(np.arange(1, n + 1), np.diff(offsets))
    out[np.arange(len(data)) + owner] = _WORD[data]
    return out, offsets + np.arange(n + 1)


def gram_slots(
    words: np.ndarray, sizes: tuple[int, ...], bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the places of n-grams inside a word, marks at its ends included, and
    their slots."""
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(words, 8))
    eight = eight.view(np.uint64).ravel()
    blank = np.concatenate([[0], np.cumsum(words == 0)])
    n = len(eight)
    for size in sizes:
        inner = blank[size - 1 : size - 1 + n] == blank[1 : 1 + n]
        at = np.flatnonzero(inner)
        keys = eight[at] & np.uint64((1 << (8 * size)) - 1)
        keys = (keys ^ (keys >> np.uint64(17)) ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        yield at, (keys >> np.uint64(64 - bits)).astype(np.int64)
