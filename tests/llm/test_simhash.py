import random

import numpy as np
import pytest
import xxhash

from ranklake.llm import golay, simhash
from ranklake.llm.components import components


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """The smallest place that chains of close pairs reach, by comparing all pairs."""
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(fps))]


def test_golay_keys_meet_within_one_bit():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    keys = golay.keys(words)
    assert set(np.unique((keys >= 0).sum(axis=1))) <= {1, 6}
    for bit in range(23):
        near = golay.keys(words ^ (1 << bit))
        shared = [set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(keys, near)]
        assert all(shared)


@pytest.mark.parametrize("flips", [1, 2, 3])
def test_close_fingerprints_share_a_key(flips):
    rng = random.Random(flips)
    fps = [rng.getrandbits(64) for _ in range(1500)]
    other = [f ^ sum(1 << b for b in rng.sample(range(64), flips)) for f in fps]

    def keys(values):
        k, place = simhash.key_rows(np.array(values, np.uint64).view(np.int64))
        found = [set() for _ in values]
        for key, at in zip(k.tolist(), place.tolist()):
            found[at].add(key)
        return found

    assert all(a & b for a, b in zip(keys(fps), keys(other)))


def test_fingerprint_of_long_and_short_texts(monkeypatch):
    texts = ["", " \n", "One", "one two", "a b c", "A b\tC  d É é", "x " * 500, "word " * 40 + "END"]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    rng = random.Random(3)
    long = " ".join(rng.choice(["aa", "bb", "ccc", "d" * 30]) for _ in range(400))
    monkeypatch.setattr(simhash, "_PIECE", 16)
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long)


def test_forest_joins_what_pairs_join():
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = [center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(300)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    a, b = simhash.close_pairs(np.zeros(len(fps), np.int64), np.array(fps, np.int64))
    place = {f: i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in zip(a.tolist(), b.tolist()):
        assert ((x ^ y) & (1 << 64) - 1).bit_count() <= 3
        i, j = sorted((top(place[x]), top(place[y])))
        parent[j] = i
    assert [top(i) for i in range(len(fps))] == plain_components([f & (1 << 64) - 1 for f in fps])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {200 + i: 100 for i in range(30)}


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(rng.choice([0, 1, 2, 5, 60, 200]))) for _ in range(60)]
    texts = base + [t + rng.choice(["", " x", " y z"]) for t in base * 2] + [None, "", "Same Text here", "same text HERE"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "n") for i, t in zip(ids, texts)] + [(None, texts[-1], "n"), (ids[0], texts[0], "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    groups = plain_components(fps)
    least = {}
    for (i, *_), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted((-1 if r[0] is None else r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, groups))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in found) == want
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.drop_near_duplicates(docs).collect() == []
