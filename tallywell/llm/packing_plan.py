"""A packing plan from counts of lengths: linear grouping, configurations of few sizes, best fit for the rest.

The plan depends on the histogram of lengths alone, which has at most ``capacity`` entries, so its size is bounded
however many pieces there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Run:
    """Pieces of ``size`` with ranks from ``rank``, one in each of ``count`` sequences from ``sequence``."""

    size: int
    rank: int
    count: int
    sequence: int
    offset: int


def grouped(sizes: np.ndarray, counts: np.ndarray, groups: int) -> list[list[int]]:
    """Sizes, from large to small, in groups of about equal numbers of pieces; the first is what all round up to."""
    order = np.argsort(-sizes)
    total, out, seen = counts.sum(), [], 0
    for i in order.tolist():
        at = int(seen * groups // max(1, total))
        if not out or at != last:
            out.append([])
            last = at
        out[-1].append(int(sizes[i]))
        seen += int(counts[i])
    return out


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of most worth that fits."""
    best = np.zeros(capacity + 1)
    picks = []
    for _ in range(capacity // int(sizes.min())):
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for i, (size, value) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
            if value <= 0:
                continue
            with_it = best[: capacity + 1 - size] + value
            better = with_it > new[size:] + 1e-12
            new[size:][better] = with_it[better]
            pick[size:][better] = i
        if (pick < 0).all():
            break
        picks.append(pick)
        best = new
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            pattern[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, int]]:
    """(pattern, sequences): whole parts of a solution of the configuration program, by column generation."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        worth = inverse.sum(axis=0)
        value, pattern = _best_pattern(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        x, step = inverse @ demand, inverse @ pattern
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaving]):
            break
        basis[:, leaving] = pattern
    x = np.linalg.solve(basis, demand)
    return [(basis[:, j].astype(np.int64), int(np.floor(x[j] + 1e-9))) for j in range(m) if x[j] >= 1]


def plan(lengths: dict[int, int], capacity: int, groups: int = 24, large: float = 0.125) -> list[Run]:
    """Runs that place each piece once; ``lengths`` maps a length of 1 to ``capacity`` to its number of pieces."""
    runs: list[Run] = []
    left = {s: n for s, n in lengths.items() if n > 0}
    used = dict.fromkeys(left, 0)
    sequence = 0
    #: Sequences that have room: room -> [(first, count, filled)].
    room: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]

    def take(size: int, count: int, first: int, offset: int) -> None:
        runs.append(Run(size, used[size], count, first, offset))
        used[size] += count
        left[size] -= count

    if left.get(capacity):
        take(capacity, left[capacity], 0, 0)
        sequence = used[capacity]
    sizes = np.array([s for s in left if s > large * capacity and left[s]], np.int64)
    if len(sizes):
        pools = grouped(sizes, np.array([left[s] for s in sizes.tolist()]), groups)
        rounded = np.array([p[0] for p in pools], np.int64)
        demand = np.array([sum(left[s] for s in p) for p in pools], float)
        for pattern, count in configurations(rounded, demand, capacity):
            slots = [g for g in range(len(pools)) for _ in range(int(pattern[g]))]
            done = 0
            while done < count and slots:
                # Real pieces for each slot, for as many sequences as their lengths stay the same.
                chosen: list[int] = []
                need: dict[int, int] = {}
                for g in slots:
                    size = next((s for s in pools[g] if left[s] - need.get(s, 0) > 0), None)
                    if size is None:
                        continue
                    chosen.append(size)
                    need[size] = need.get(size, 0) + 1
                if not chosen:
                    break
                many = min([count - done, *(left[s] // n for s, n in need.items())])
                filled = 0
                for size in chosen:
                    take(size, many, sequence, filled)
                    filled += size
                room[capacity - filled].append((sequence, many, filled))
                sequence += many
                done += many
    for size in sorted((s for s in left if left[s]), reverse=True):
        for space in range(size, capacity + 1):
            while room[space] and left[size]:
                first, count, filled = room[space].pop()
                each = space // size
                full = min(count, left[size] // each)
                for j in range(each if full else 0):
                    take(size, full, first, filled + j * size)
                if full:
                    room[space - each * size].append((first, full, filled + each * size))
                if full < count:
                    rest = min(left[size], each)
                    for j in range(rest):
                        take(size, 1, first + full, filled + j * size)
                    if rest:
                        room[space - rest * size].append((first + full, 1, filled + rest * size))
                    if count - full - (rest > 0):
                        room[space].append((first + full + (rest > 0), count - full - (rest > 0), filled))
            if not left[size]:
                break
        if left[size]:
            each = capacity // size
            full, rest = divmod(left[size], each)
            for j in range(each if full else 0):
                take(size, full, sequence, j * size)
            if full:
                room[capacity - each * size].append((sequence, full, each * size))
            sequence += full
            for j in range(rest):
                take(size, 1, sequence, j * size)
            if rest:
                room[capacity - rest * size].append((sequence, 1, rest * size))
                sequence += 1
    return runs
