"""Anchors of a byte string, chosen by content: every window of a given length has one, wherever the window stands."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from bitextloom.llm.shingles import mixed

# Bytes of the grams among which a window chooses; a power of two.
GRAM = 64
# Positions within one pass; the low bits of a rank tell equal hashes apart.
PLACE_BITS = 22
PIECE = 1 << 20
FACTOR = 0x9E3779B97F4A7C15


class Anchors(NamedTuple):
    """Runs of windows that choose one gram: hash of the gram, first window, number of windows, the gram's place."""

    gram: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    place: np.ndarray


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on, by doubling."""
    hashes, length, factor = data.astype(np.uint64) + np.uint64(1), 1, FACTOR
    while length < GRAM:
        # The first of two halves times a power of the factor, plus the second.
        hashes = hashes[:-length] * np.uint64(factor) + hashes[length:]
        factor, length = factor * factor % 2**64, 2 * length
    return mixed(hashes)


def least_of_windows(ranks: np.ndarray, width: int) -> np.ndarray:
    """The least of ranks[i:i + width] for each i, from running minima of blocks forward and backward."""
    blocks = -(-len(ranks) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranks)] = ranks
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(ranks) - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, starts: np.ndarray, window: int) -> Anchors:
    """Anchors of several texts that lie in `data` one behind the other; text t begins at starts[t], starts[-1] is the end.

    A window of `window` bytes chooses the last of its grams with the least hash, so equal windows choose alike, and
    consecutive windows mostly the same gram. Windows that would cross the end of a text choose none.
    """
    parts = [piece_anchors(data, starts, window, at, min(at + PIECE, len(data) - window + 1)) for at in range(0, len(data) - window + 1, PIECE)]
    if not parts:
        none = np.zeros(0, np.int64)
        return Anchors(none.astype(np.uint64), none, none, none)
    return Anchors(*(np.concatenate(column) for column in zip(*parts)))


def piece_anchors(data: np.ndarray, starts: np.ndarray, window: int, low: int, high: int) -> Anchors:
    """Anchors of the windows that begin in [low, high)."""
    hashes = gram_hashes(data[low : high - 1 + window])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    chosen = least_of_windows((hashes & ~mask) | (mask - places), window - GRAM + 1)
    place = (mask - (chosen & mask)).astype(np.int64)
    at = np.arange(low, high)
    text = np.searchsorted(starts, at, "right") - 1
    inside = at + window <= starts[text + 1]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    # A run ends before the next one, or where windows stop fitting into their text.
    ends = np.concatenate([np.flatnonzero(new | ~inside), [len(at)]])
    last = ends[np.searchsorted(ends, first, "right")]
    return Anchors(hashes[place[first]], first + low, last - first, place[first] + low)
