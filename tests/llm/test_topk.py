import math
import random

import numpy as np
import pytest

from ranklake.llm import topk


def plain(rows, k=5):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q in {i for i, _ in usable if i % 50 == 0}:
        asked = [v for i, v in usable if i == q]
        scored = [(-sum(map(int.__mul__, a, v)), i) for a in asked for i, v in usable if i != q and len(v) == len(a)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("n", [3, 400])
def test_against_all_pairs(spark, monkeypatch, n):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = random.Random(n)
    rows = [(i, [rng.choice([rng.gauss(0, 0.3), 0.0, -1.5]) for _ in range(6)]) for i in range(n)]
    rows += [(1000 + i, rows[1][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2050, [0.1, None] + [0.0] * 4), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (None, [0.5] * 6)]
    rows += [(3000, [0.25, 0.5]), (3001, [1.0, 1.0]), (3050, []), (50, rows[0][1]), (50, rows[0][1])]
    rows += [(1, [9.0] * 6), (1, [9.0] * 6), (2, [-9.0] * 6), (0, [7.5] * 6)]  # repeated ids, better and worse
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = topk.top_k(frame, topk.F.col("id") % 50 == 0)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(tuple(r) for r in found.collect()) == plain(exact)


def test_bounds_never_lose_a_winner():
    rng = np.random.default_rng(3)
    data = rng.integers(-300, 300, (500, 16))
    asked = np.concatenate([rng.integers(-300, 300, (20, 16)), data[:3], np.zeros((1, 16), int)])
    skip = np.full(len(asked), -1)
    skip[20:23] = range(3)
    own = np.arange(20, 23), np.arange(3)
    for q, able in enumerate(topk.nra(asked, data, 5, own)):
        scores = data @ asked[q]
        if skip[q] >= 0:
            scores[skip[q]] = -(10**9)
        kth = np.sort(scores)[-5]
        assert set(np.flatnonzero(scores >= kth)) <= set(able.tolist())


def test_reading_stops_early():
    rng = np.random.default_rng(1)
    data = rng.integers(-20, 20, (2000, 4))
    data[7] = 900
    found = topk.nra(np.array([[50, 40, 30, 20]]), data, 1, (np.empty(0, int), np.empty(0, int)))[0]
    assert 7 in found and len(found) <= topk.FEW


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, topk.F.col("id") % 50 == 0).collect() == []


def test_vectors_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e300, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        topk.top_k(frame, topk.F.col("id") % 50 == 0).collect()
