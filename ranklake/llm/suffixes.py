"""Suffix order of a string by the difference cover of 3, up to a given depth.

Suffixes at two of every three places are sampled. Their triples are sorted and named; if names repeat and
do not reach far enough yet, the string of names is ordered in the same way. Then the third class of
suffixes is ordered by its first symbol and the rank of what follows, and the classes are merged. All
steps are sorts and binary searches over whole arrays.
"""

from __future__ import annotations

import numpy as np

#: Symbols and ranks are packed three to a number.
_BITS = 21
LIMIT = (1 << _BITS) - 4


def _pack(*parts: np.ndarray) -> np.ndarray:
    packed = parts[0].astype(np.int64)
    for part in parts[1:]:
        packed = packed << _BITS | part
    return packed


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """The dense rank of each key from 1, and how many there are."""
    found, names = np.unique(keys, return_inverse=True)
    return names + 1, len(found)


def order_places(symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix how many sort before it.

    Suffixes that agree in their first ``depth`` symbols get neighbouring places, with no other suffix between;
    beyond that the order is that of the suffixes as far as names reach. Symbols are from 1 up to ``LIMIT``.
    """
    n = len(symbols)
    if n < 4:
        text = [tuple(symbols[i:]) for i in range(n)]
        return np.array([sum(t < own for t in text) for own in text], np.int64)
    s = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    first, second = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)  # may hold the end, which sorts before all
    sampled = np.concatenate([first, second])
    names, kinds = _names(_pack(s[sampled], s[sampled + 1], s[sampled + 2]))
    if kinds < len(sampled) and depth > 3:
        # A name that ends the first half holds a zero, so names never run over into the second half unseen.
        names = order_places(np.concatenate([names[: len(first)], [kinds + 1], names[len(first) :]]), -(-depth // 3))
        names = np.delete(names, len(first)) + 1
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = names
    third = np.arange(0, n, 3)
    by_one = _pack(s[third], rank[third + 1])
    by_two = _pack(s[third], s[third + 1], rank[third + 2])
    first, second = first[first < n], second[second < n]
    one = _pack(s[first], rank[first + 1])
    two = _pack(s[second], s[second + 1], rank[second + 2])

    def before(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.sort(keys), asked)

    places = np.empty(n, np.int64)
    places[third] = before(by_one, by_one) + before(one, by_one) + before(two, by_two)
    both = np.concatenate([rank[first], rank[second]])
    own = before(both, both)
    places[first] = own[: len(first)] + before(by_one, one)
    places[second] = own[len(first) :] + before(by_two, two)
    return places
