"""Counting near points by sorting, for windows of up to three values."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Up to this many points all pairs are compared, which is faster than sorting.
ALL_PAIRS = 512


class _Ranks:
    """How many of the numbers at places lo to hi are below v, for many (lo, hi, v) at once (a wavelet matrix)."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            one = (numbers >> bit) & 1
            self.levels.append((bit, np.append(0, np.cumsum(1 - one))))
            numbers = np.concatenate((numbers[one == 0], numbers[one == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, v: np.ndarray) -> np.ndarray:
        count = np.zeros(len(v), np.int64)
        for bit, zeros in self.levels:
            lo0, hi0, up = zeros[lo], zeros[hi], (v >> bit) & 1 == 1
            count += np.where(up, hi0 - lo0, 0)
            lo = np.where(up, zeros[-1] + lo - lo0, lo0)
            hi = np.where(up, zeros[-1] + hi - hi0, hi0)
        return count

    def between(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, limit: np.ndarray) -> np.ndarray:
        return self.below(lo, hi, limit) - self.below(lo, hi, least)


def _first(values: np.ndarray, holds) -> np.ndarray:
    """For every query the first place of the sorted values where ``holds(value)``, which then holds on."""
    low = np.zeros(len(values), np.int64)
    high = np.full(len(values), len(values))
    while (low < high).any():
        middle = (low + high) // 2
        found = holds(values[np.minimum(middle, len(values) - 1)]) | (middle >= high)
        low, high = np.where(found, low, middle + 1), np.where(found, np.minimum(middle, high), high)
    return low


def _all_pairs(points: np.ndarray, tolerance: float) -> np.ndarray:
    step = max(1, 1_000_000 // max(len(points), 1))
    counts = np.zeros(len(points), np.int64)
    for at in range(0, len(points), step):
        near = np.ones((len(points[at : at + step]), len(points)), dtype=bool)
        for column in points.T:
            near &= np.abs(column[at : at + step, None] - column[None, :]) <= tolerance
        counts[at : at + step] = near.sum(axis=1)
    return counts


def near_counts(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Per point, how many points (itself included) differ from it by at most the tolerance in every coordinate.

    Each coordinate is sorted, and what is near is a range of its order. One range is a difference of places, two meet
    in a rank count, and for three the first order is cut into blocks of 1, 2, 4, ... places, of which a range needs
    two of each size: n log n steps for two, n log^2 n for three coordinates. More are compared pair by pair.
    """
    n, width = points.shape
    if n <= ALL_PAIRS or width > 3:
        return _all_pairs(points, tolerance)
    bits = n.bit_length()
    orders, places, least, limit = [], [], [], []
    for column in points.T:
        order = np.argsort(column, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        orders.append(order)
        places.append(place)
        least.append(_first(column[order], lambda v, x=column: x - v <= tolerance))
        limit.append(_first(column[order], lambda v, x=column: v - x > tolerance))
    if width == 1:
        return limit[0] - least[0]
    if width == 2:
        return _Ranks(places[1][orders[0]], bits).between(least[0], limit[0], least[1], limit[1])
    counts = np.zeros(n, np.int64)
    lo, hi = least[0], limit[0]
    for size in range(bits):
        open_ = lo < hi
        if not open_.any():
            break
        # Points by block of 2^size places of the first order, and in a block by the second.
        key = (places[0] >> size) * n + places[1]
        order = np.argsort(key)
        key, ranks = key[order], _Ranks(places[2][order], bits)
        for taken, block in ((open_ & (lo & 1 == 1), lo), (open_ & (hi & 1 == 1), hi - 1)):
            q = np.flatnonzero(taken)
            start = block[q] * n
            a, b = np.searchsorted(key, start + least[1][q]), np.searchsorted(key, start + limit[1][q])
            counts[q] += ranks.between(a, b, least[2][q], limit[2][q])
        lo, hi = (lo + 1) >> 1, hi >> 1
    return counts


def gaps(x: np.ndarray, room: np.ndarray | None = None) -> np.ndarray | None:
    """The distances of all pairs of up to ``ALL_PAIRS`` values, of more None.

    ``room`` may be memory for ``ALL_PAIRS ** 2`` numbers, kept for the next series.
    """
    n = len(x)
    if n > ALL_PAIRS:
        return None
    out = np.empty((n, n)) if room is None else room[: n * n].reshape(n, n)
    return np.abs(np.subtract(x[:, None], x, out=out), out=out)


def near_windows(x: np.ndarray, gap: np.ndarray | None, sizes: Sequence[int], tolerance: float) -> list[np.ndarray]:
    """``near_counts`` of the windows of consecutive values, for ascending sizes. ``gap`` is ``gaps(x)``.

    Windows are near where the pairs of their values are, so one matrix of pairs, moved along its diagonal, serves
    all sizes.
    """
    if gap is None:
        return [near_counts(np.lib.stride_tricks.sliding_window_view(x, size), tolerance) for size in sizes]
    pairs = gap <= tolerance
    near, of, counts = pairs, 1, []
    for size in sizes:
        for k in range(of, size):
            near = near[:-1, :-1] & pairs[k:, k:]
        of = size
        counts.append(np.add.reduce(near.view(np.uint8), axis=0, dtype=np.uint16).astype(np.int64))
    return counts
