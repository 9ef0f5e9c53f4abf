"""The cutting-stock problem for a histogram of lengths, by column generation.

A pattern says how many pieces of each length one sequence holds. The linear program finds how often
to use which pattern so that all pieces are placed in the fewest sequences. Its columns are patterns, too
many to list; a knapsack by dynamic programming over the dual prices finds the next one worth having.
Counts are rounded down, and what is left over, at most a few pieces for each pattern, is
placed longest first. All sizes here are bounded by the capacity, whatever the number of pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Use:
    """A pattern, as lengths in descending order, and how many sequences follow it."""

    lengths: list[int]
    times: int


def _longest_first(left: np.ndarray, room: int) -> dict[int, int]:
    """A pattern of the longest pieces that still fit, no more of a length than are left (a part counts as one)."""
    counts: dict[int, int] = {}
    there = np.flatnonzero(left > 0)
    while room:
        there = there[: np.searchsorted(there, room, "right")]
        if not len(there):
            break
        length, there = int(there[-1]), there[:-1]
        counts[length] = int(min(room // length, np.ceil(left[length])))
        room -= counts[length] * length
    return counts


def fill(demand: np.ndarray) -> list[Use]:
    """Longest first: each sequence takes the longest pieces that still fit, as often as they last."""
    left, uses = demand.astype(np.int64).copy(), []
    while left.any():
        counts = _longest_first(left, len(demand) - 1)
        times = min(int(left[x]) // n for x, n in counts.items())
        for x, n in counts.items():
            left[x] -= times * n
        uses.append(Use([x for x, n in counts.items() for _ in range(n)], times))
    return uses


def price(lengths: np.ndarray, duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest value: its value, and its count of each of ``lengths``."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = np.searchsorted(lengths, room, "right")
        if n:
            values = best[room - lengths[:n]] + duals[:n]
            i = int(values.argmax())
            if values[i] > best[room - 1]:
                best[room], last[room] = values[i], i
                continue
        best[room], last[room] = best[room - 1], -1
    counts, room = np.zeros(len(lengths)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= lengths[last[room]]
    return best[capacity], counts


def _start(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A basis of the linear program: patterns longest first, each used until it has used up a length."""
    place = {int(x): i for i, x in enumerate(lengths)}
    left = np.zeros(capacity + 1)
    left[lengths] = demand
    columns, times = [], []
    while left.any():
        counts = _longest_first(left, capacity)
        use = min(left[x] / n for x, n in counts.items())
        done = [x for x, n in counts.items() if left[x] / n <= use * (1 + 1e-12)]
        column = np.zeros(len(lengths))
        for x, n in counts.items():
            column[place[x]] = n
            left[x] = 0 if x in done else left[x] - use * n
        columns.append(column)
        times.append(use)
        for x in done[1:]:  # used up at the same time: a pattern of its own, used no times
            columns.append(np.eye(1, len(lengths), place[x])[0] * (capacity // x))
            times.append(0)
    return np.array(columns).T, np.array(times, float)


def solve(demand: np.ndarray, rounds: int = 100, gap: float = 0.0005) -> list[Use]:
    """Patterns that hold ``demand[x]`` pieces of each length ``x``, exactly. The capacity is the last length.

    Columns are generated until none improves, the bound on what can still be won is below ``gap``, or
    ``rounds`` are over; any of them leaves a complete plan. An empty demand gives no patterns.
    """
    capacity = len(demand) - 1
    lengths = np.flatnonzero(demand)
    if not len(lengths):
        return []
    need = demand[lengths].astype(float)
    basis, used = _start(lengths, need, capacity)
    inverse = np.linalg.inv(basis)
    bound = (lengths * need).sum() / capacity
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        value, column = price(lengths, duals, capacity)
        total = used.sum()
        bound = max(bound, total / max(value, 1.0))  # prices divided by the best value are feasible prices
        if value <= 1 + 1e-9 or total <= bound * (1 + gap):
            break
        change = inverse @ column
        able = change > 1e-9
        if not able.any():
            break
        ratios = np.where(able, used / np.where(able, change, 1), np.inf)
        out = int(ratios.argmin())
        step = ratios[out]
        used = np.maximum(used - step * change, 0)
        used[out] = step
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    left = demand.astype(np.int64).copy()
    uses = []
    for j in np.argsort(-used):
        times = int(used[j] + 1e-6)
        counts = basis[:, j].astype(np.int64)
        some = counts > 0
        times = min([times, *(left[lengths[some]] // counts[some])])
        if times > 0:
            left[lengths] -= times * counts
            uses.append(Use([int(x) for x, n in zip(lengths[::-1], counts[::-1]) for _ in range(n)], int(times)))
    return uses + fill(left)
