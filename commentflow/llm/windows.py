"""Fixed-length windows of texts, told apart by content-chosen anchors.

The anchor of a window is the least hash among the window's grams, the leftmost of equals. It depends on the
window's content only, so equal windows have equal anchors at equal distances, and consecutive windows mostly
share theirs. A run of windows with one anchor is a unit of work: only runs whose anchor hash occurs twice can hold
windows that occur twice, and equal windows always lie in runs with the same anchor hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from commentflow.llm.wordhash import _tables, mixed

PIECE = 1 << 20
_LOW = np.uint64((1 << 24) - 1)


def byte_grams(data: np.ndarray, gram: int) -> Callable[[int, int], np.ndarray]:
    """Hashes of the ``gram`` bytes from each of the offsets p, ..., q - 1."""

    def of(p: int, q: int) -> np.ndarray:
        part = data[p:q + gram - 1]
        powers, inverses = _tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[:len(part)], out=sums[1:])
        return mixed((sums[gram:] - sums[:-gram]) * inverses[:q - p])

    return of


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchored_runs(
    grams: Callable[[int, int], np.ndarray], bounds: np.ndarray, window: int, gram: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs (text, first window, number of windows, anchor hash) of texts laid end to end at ``bounds``.

    ``grams(p, q)`` hashes the grams that start at the units p, ..., q - 1. A run never leaves its text; long texts
    are worked off in pieces, at which runs may break."""
    total = int(bounds[-1])
    width = window - gram + 1
    last = total - window + 1
    for p in range(0, max(0, last), PIECE):
        q = min(last, p + PIECE)
        h = grams(p, q + width - 1)
        place = np.arange(len(h), dtype=np.uint64)
        least = _sliding_min((h & ~_LOW) | place, width)
        at = (least & _LOW).astype(np.int64)
        # Windows that begin less than their length before the end of a text are none.
        ends = bounds[1:]
        low, high = int(np.searchsorted(bounds, p, side="right")) - 1, int(np.searchsorted(bounds, q, side="left"))
        closed = np.zeros(q - p + 1, dtype=np.int64)
        begin = np.clip(np.maximum(ends[low:high] - window + 1, bounds[low:high]) - p, 0, q - p)
        end = np.clip(ends[low:high] - p, 0, q - p)
        np.add.at(closed, begin, 1)
        np.add.at(closed, end, -1)
        valid = np.cumsum(closed[:-1]) == 0
        change = np.empty(q - p, dtype=bool)
        change[0] = True
        change[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(change)
        size = np.diff(np.append(start, q - p))
        ok = valid[start]
        start, size = start[ok], size[ok]
        which = np.searchsorted(bounds, start + p, side="right") - 1
        yield which, start + p - bounds[which], size, h[at[start]].view(np.int64)


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans as sorted, disjoint, non-adjacent spans."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out
