"""Word shingles of a text as 64-bit hashes, and min-hash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

# Shingles that are hashed by all functions at once.
SLICE = 4096


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words: A-Z lower-cased, split at ASCII white space alone, as bytes do both."""
    words = text.encode().lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sequence(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of runs of `width` words in order; of fewer words, one hash of them all; of none, none."""
    if not len(words):
        return words
    taken = min(width, len(words))
    runs = np.full(len(words) - taken + 1, taken, np.uint64)
    for i in range(taken):
        runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - taken + 1 + i])
    return runs


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_sequence(word_hashes(text), width))


def multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each factor the least 32-bit hash over the shingles, some thousands of them at a time."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(shingles), SLICE):
        part = shingles[None, first : first + SLICE] * factors[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least >> np.uint64(32)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
