"""Cutting stock on a histogram of piece lengths: column generation, rounding, and the ranges of pieces each pattern takes.

Everything here works on counts by length, at most one number for each length up to the sequence size, whatever the corpus.
"""

from __future__ import annotations

import heapq

import numpy as np


def best_pattern(value: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The fill of ``size`` with the largest sum of values, by dynamic programming over the filled length.

    ``value[l]`` is the worth of a piece of length l (0 or less: not used). Returns that sum and the count of each length.
    """
    best, last = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for c in range(1, size + 1):
        sums = value[1:c + 1] + best[c - 1::-1][:c]
        k = int(sums.argmax())
        if sums[k] > best[c - 1] + 1e-12:
            best[c], last[c] = sums[k], k + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(size + 1, np.int64), size
    while c > 0:
        if last[c]:
            counts[last[c]] += 1
            c -= last[c]
        else:
            c -= 1
    return float(best[size]), counts


def patterns(demand: np.ndarray, size: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """(counts by length, how many times) of the basis that solves the linear program over patterns.

    ``demand[l]`` counts the pieces of length l. The first basis repeats one length; each round the knapsack prices the
    best new pattern by the dual values and the ratio test picks the one it replaces. Stops when none improves, or after
    ``rounds`` with the basis it has, which still covers the demand.
    """
    lengths = np.flatnonzero(demand)
    m = len(lengths)
    if not m:
        return []
    columns = np.diag(size // lengths).astype(float)
    inverse = np.diag(1.0 / (size // lengths))
    times = inverse @ demand[lengths]
    for _ in range(rounds):
        dual = inverse.sum(axis=0)
        value = np.zeros(size + 1)
        value[lengths] = dual
        total, counts = best_pattern(value, size)
        if total <= 1 + 1e-9:
            break
        column = counts[lengths].astype(float)
        step = inverse @ column
        usable = step > 1e-9
        if not usable.any():
            break
        ratio = np.where(usable, times / np.where(usable, step, 1), np.inf)
        out = int(ratio.argmin())
        times = np.maximum(times - step * ratio[out], 0)
        times[out] = ratio[out]
        columns[:, out] = column
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
    out = []
    for k in range(m):
        counts = np.zeros(size + 1, np.int64)
        counts[lengths] = columns[:, k].astype(np.int64)
        out.append((counts, float(times[k])))
    return out


def plan(demand: np.ndarray, size: int, rounds: int = 2000) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a sequence, first sequence, offset) rows that place every ranked piece once.

    The piece of rank r lies in sequence ``first sequence + (r - first rank) // pieces``. Patterns are rounded down; pieces
    that remain fill the fullest sequence they fit in, longest first. Their number depends on the number of patterns only.
    """
    rows, used, sequence = [], np.zeros(size + 1, np.int64), 0
    for counts, times in patterns(demand, size, rounds):
        n = int(times + 1e-7)
        lengths = np.flatnonzero(counts)
        if len(lengths):
            n = min(n, int(((demand[lengths] - used[lengths]) // counts[lengths]).min()))
        if n <= 0 or not len(lengths):
            continue
        at = 0
        for length in lengths[::-1].tolist():
            k = int(counts[length])
            rows.append((length, int(used[length]), int(used[length]) + k * n, k, sequence, at))
            used[length] += k * n
            at += k * length
        sequence += n
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    for length in range(size, 0, -1):
        while used[length] < demand[length]:
            room = min((r for r in open_by_room if r >= length and open_by_room[r]), default=None)
            if room is None:
                n, offset, room = sequence, 0, size
                sequence += 1
            else:
                n, offset = heapq.heappop(open_by_room[room])
            rows.append((length, int(used[length]), int(used[length]) + 1, 1, n, offset))
            used[length] += 1
            if room > length:
                heapq.heappush(open_by_room.setdefault(room - length, []), (n, offset + length))
    return rows
