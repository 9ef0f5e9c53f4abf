import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ranklake.llm import passages
from ranklake.llm.suffixes import order_places


@pytest.mark.parametrize("letters", [1, 2, 5])
def test_suffix_order(letters):
    rng = random.Random(letters)
    for _ in range(300):
        s = [rng.randint(1, letters) for _ in range(rng.randint(1, 60))]
        places = order_places(np.array(s), 10**6).tolist()
        assert [sorted(s[i:] for i in range(len(s)))[p] for p in places] == [s[i:] for i in range(len(s))]
        depth = rng.randint(1, 8)
        order = np.argsort(order_places(np.array(s), depth), kind="stable")
        heads = [tuple((s + [0] * depth)[i : i + depth]) for i in order]
        runs = sum(a != b for a, b in zip(heads, heads[1:])) + 1
        assert runs == len(set(heads))


def plain(texts, length=200):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone[: len(t)].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = [prose(rng.randint(0, 120)) for _ in range(20)]
    texts += [prose(20) + rng.choice(shared)[rng.randint(0, 40) : rng.randint(150, 400)] + prose(20) for _ in range(40)]
    texts += texts[:5] + [None, "", "x" * 199, "y" * 200, "z" * 201, "ab" * 400, "q" * 50 + "ab" * 120, shared[0] * 3]
    texts += [t.replace("a", "b", 1) for t in texts[20:40] if t]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_strings(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in passages.remove_repeats(docs).collect()}
    assert [found[i] for i in range(len(texts))] == plain(texts)


def test_anchor_too_common_for_a_task(spark, monkeypatch):
    texts = corpus(3)
    long = [t.encode() for t in texts if len((t or "").encode()) >= 200]
    stretches = [(a, t[s : s + n + 199], p - s) for t in long for x in passages.stretches(t) for a, s, n, p in zip(*(y.tolist() for y in x))]
    ordered = sorted((a, passages._digest(b), at, n, b) for (a, b, at), n in Counter(stretches).items())
    import pyarrow as pa

    def judge():
        names = ("anchor", "digest", "at", "n", "bytes")
        batches = [pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*ordered[i : i + 7]))))) for i in range(0, len(ordered), 7)]
        return [r for b in passages._judge(iter(batches)) for r in b.to_pylist()]

    flags = lambda spans: sorted(x for a, b in zip(spans[::2], spans[1::2]) for x in range(a, b))
    whole = {(r["anchor"], r["digest"]): flags(r["spans"]) for r in judge()}
    monkeypatch.setattr(passages, "MOST", 400)
    parted = judge()
    over = [r for r in parted if r["spans"] is None]
    assert over
    frame = spark.createDataFrame([(r["anchor"], r["digest"], None, r["n"], r["bytes"]) for r in over], passages._JUDGED)
    again = {(r["anchor"], r["digest"]): flags(r["spans"]) for r in parted if r["spans"] is not None}
    again |= {(r.anchor, r.digest): flags(r.spans) for r in passages._counted_strings(frame).collect()}
    assert again == whole


def test_long_texts_in_pieces(monkeypatch):
    text = corpus(4)[30].encode() * 20
    whole = [tuple(map(int, x)) for part in passages.stretches(text) for x in zip(*part)]
    monkeypatch.setattr(passages, "_PIECE", 300)
    pieces = [tuple(map(int, x)) for part in passages.stretches(text) for x in zip(*part)]
    anchor_of = lambda rows: {s + i: (a, p) for a, s, n, p in rows for i in range(n)}
    assert anchor_of(whole) == anchor_of(pieces)


def test_empty_table(spark):
    assert passages.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
