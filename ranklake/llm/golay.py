"""The binary Golay code of 23 bits, for hashing words that differ in a bit to a common key.

Every 23-bit word lies within 3 bits of exactly one of the 4096 codewords. The keys of a word are the
data bits of all codewords within 4 bits of it, one to six of them. Of two words that differ in at
most one bit, the nearest codeword of the one is within 4 bits of the other, so they share that key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

#: Generator polynomial of the code, a fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011


def _remainder(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << (bit - 11)), rest)
    return rest


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low and the high bits; per remainder the error, and what to add for each key (-1: none)."""
    low, high = _remainder(np.arange(1 << 12)), _remainder(np.arange(1 << 11) << 12)
    data = np.arange(1 << 12) << 11
    codewords = data | _remainder(data)
    errors = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)])
    leader = np.empty(1 << 11, np.int64)
    leader[_remainder(errors)] = errors
    near = np.full((1 << 11, 6), -1, np.int64)
    for rest, error in enumerate(leader):
        found = np.flatnonzero(np.bitwise_count(codewords ^ error) <= 4)
        near[rest, : len(found)] = np.sort(found)
    return low, high, leader, near


def keys(words: np.ndarray) -> np.ndarray:
    """Per word six keys of 12 bits, -1 where there are fewer. The first is that of the nearest codeword."""
    low, high, leader, near = _tables()
    rest = low[words & 0xFFF] ^ high[words >> 12]
    nearest = (words ^ leader[rest]) >> 11
    add = near[rest]
    return np.where(add < 0, -1, nearest[:, None] ^ add)
