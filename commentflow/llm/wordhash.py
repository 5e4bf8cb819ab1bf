"""Words of UTF-8 texts as numpy arrays: where they lie and a 64-bit hash of each, without a Python loop over words."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(12, (n - 1).bit_length())
        _powers, _inverses = (np.full(size, base, dtype=np.uint64) for base in (_BASE, _INVERSE))
        for table in (_powers, _inverses):
            table[0] = 1
            np.cumprod(table, out=table)
    return _powers, _inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANK[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: polynomials of their bytes by differences of running sums, in bounded pieces."""
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + _PIECE, side="right")))
        low = int(starts[k])
        size = int(ends[stop - 1]) - low
        powers, inverses = _tables(size + 1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((data[low:low + size].astype(np.uint64) + np.uint64(1)) * powers[:size], out=sums[1:])
        s, e = starts[k:stop] - low, ends[k:stop] - low
        out[k:stop] = (sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64) * np.uint64(_BASE)
        k = stop
    return mixed(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words; the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j:n - size + 1 + j]
    return mixed(out)
