"""Word shingles as sorted arrays of distinct 64-bit hashes, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words: runs of anything but ASCII white space, A-Z in lower case."""
    words = text.encode().lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """The hash of each shingle in text order: ``words`` words in a row, or all of a shorter text as one."""
    hashes = word_hashes(text)
    width = min(words, len(hashes))
    if not width:
        return hashes
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * STEP + hashes[k:k + len(out)])
    return out


def shingle_set(text: str, words: int) -> np.ndarray:
    """A text's distinct shingles, sorted."""
    return np.unique(shingle_hashes(text, words))
