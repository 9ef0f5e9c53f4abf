import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from ranklake.llm import similar


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_overlap_and_sets():
    sets = [similar.shingle_set(t.encode(), 5) for t in ("a b c d e f", "A B c d e\n f", "a b", "", "a b c d e g")]
    assert [len(s) for s in sets] == [2, 2, 1, 0, 2]
    assert similar.overlap(sets[0], sets[1]) == 1 and similar.overlap(sets[0], sets[2]) == 0
    assert similar.overlap(sets[3], sets[3]) == 1 and similar.overlap(sets[0], sets[4]) == pytest.approx(1 / 3)
    assert similar.word_prints(b" \n", 3) == [0]
    assert similar.word_prints("É a b".encode(), 4) == similar.word_prints("b  É A".encode(), 4)


def test_one_of_each_group_stays(spark):
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([40, 120, 400]))) for _ in range(50)]
    texts = list(base)
    for t in base[:20]:
        words = t.split()
        texts.append(" ".join([*words[:-1], "end"]))
        words[len(words) // 2] = "middle"
        texts.append(" ".join(words))
    for _ in range(120):  # a large group, each copy with one word changed
        words = base[49].split()
        words[rng.randrange(len(words))] = f"n{rng.randint(0, 9)}"
        texts.append(" ".join(words))
    texts += [None, "", " ", "one", "One", "one two"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "mine") for i, t in zip(ids, texts)] + [(None, base[0], "mine"), (ids[0], base[0], "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = similar.drop_similar(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    # All pairs, compared in plain Python.
    sets = [shingles(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            every = len(sets[i] | sets[j])
            if group[i] != group[j] and (not every or len(sets[i] & sets[j]) / every >= 0.8):
                group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for (i, t, _), g in zip(rows, group):
        own = (i is None, i or 0, t or "")
        least[g] = min(own, least.get(g, own), key=lambda x: x[:2])
    assert [x[:2] for x in found] == sorted(x[:2] for x in least.values())
    assert {r.node for r in kept.collect()} == {"mine"}


def test_no_limit_costs_a_link(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
    texts = []
    for n in range(90):  # words of one text moved, so that all have its fingerprints, or changed; some pairs pass the check
        words = list(base)
        for _ in range(n % 7):
            i, j = rng.randrange(len(words)), rng.randrange(len(words))
            words[i], words[j] = words[j], words[i] if n % 2 else f"n{n % 5}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def groups(nearest):
        monkeypatch.setattr(similar, "NEAREST", nearest)
        found = defaultdict(set)
        for r in similar.similar(docs).collect():
            found[r.root].add(r.id)
        return sorted(map(sorted, found.values()))

    free = groups(1 << 30)
    assert len(free) > 1 and max(map(len, free)) > 20
    assert groups(1) == groups(3) == free


def test_words_in_another_order_share_fingerprints_and_links_are_found(spark):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
    orders = [rng.sample(base, len(base)) for _ in range(20)]
    texts = [" ".join(w) for words in orders for w in (words, [words[1], words[0], *words[2:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in similar.drop_similar(docs).orderBy("doc_id").collect()] == list(range(0, 40, 2))


def test_runs_are_never_cut():
    keys = np.repeat(np.arange(5), [1, 4, 2, 9, 1])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 3])], names=["key"]) for i in range(0, len(keys), 3)]
    lots = [lot[0] for lot in similar._runs(iter(batches))]
    assert np.concatenate(lots).tolist() == keys.tolist()
    assert all(a[-1] != b[0] for a, b in zip(lots, lots[1:]))


def test_empty_table(spark):
    assert similar.drop_similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []


TABLE = Path("/root/testdata/sf0.1/documents.parquet")


@pytest.mark.skipif(not TABLE.exists(), reason="needs the benchmark tables")
def test_recall_over_the_benchmark_documents(spark):
    from ranklake.llm import exact
    from ranklake.session import settle

    docs = settle(exact.drop_copies(spark.read.parquet(str(TABLE))), "recall")
    roots = {r.id: r.root for r in similar.similar(docs).select("id", "root").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    held, shared = defaultdict(list), Counter()
    for i, own in sets.items():
        for s in own:
            held[s].append(i)
    for ids in held.values():
        if 1 < len(ids) < 400:
            shared.update((a, b) for n, a in enumerate(ids) for b in ids[:n])
    near = [p for p, n in shared.items() if n / len(sets[p[0]] | sets[p[1]]) >= 0.8]
    assert len(near) > 20
    assert np.mean([roots[a] == roots[b] for a, b in near]) >= 0.9
    # Nothing is linked that chains of such pairs do not link.
    group = {i: i for i in texts}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in near:
        group[max(top(a), top(b))] = min(top(a), top(b))
    linked = defaultdict(set)
    for i, root in roots.items():
        linked[root].add(top(i))
    joined = [g for g in linked.values() if len(g) > 1]
    assert not [g for g in joined if any(re.search(r"\w", texts[i] or "") for i in g)]


@pytest.mark.parametrize("similarity", [0.6, 0.8])
def test_every_pair_that_passes_is_joined(spark, similarity):
    """Also those whose fingerprints are far apart."""
    rng = random.Random(11)
    texts = []
    for n in range(120):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([22, 50, 60]))]
        texts.append(" ".join(words))
        for i in (len(words) // 2, 1):  # one word changed, then two
            words[i] = f"m{n}"
            texts.append(" ".join(words))
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    held = defaultdict(set)
    for i, own in enumerate(sets):
        for j in {j for s in own for j in held[s]}:
            if len(own & sets[j]) / len(own | sets[j]) >= similarity:
                group[top(i)] = top(j)
        for s in own:
            held[s].add(i)
    wanted = defaultdict(set)
    for i in range(len(texts)):
        wanted[top(i)].add(i)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(set)
    for r in similar.similar(docs, similarity=similarity).collect():
        found[r.root].add(r.id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))


def test_meeting_finds_pairs_of_other_roots_in_long_and_short_runs():
    for n in (5, 200):
        nodes = np.arange(n)
        roots = np.where(nodes % 3, nodes, 0)
        sizes = np.where(nodes == 1, 5, 10)
        lot = [np.full(n, 7), nodes, roots, sizes, np.where(nodes == 2, 9, 0)]
        pairs = {tuple(sorted(p)) for p in np.concatenate(list(similar.meeting(lot, 0.8, 100)), axis=1).T.tolist()}
        able = [i for i in range(n) if i not in (1, 2)]  # one is too short, of the other too little is left
        assert pairs == {(a, b) for a in able for b in able if a < b and roots[a] != roots[b]}
    none = [np.zeros(3, int), np.array([4, 2, 3]), np.array([4, 2, 3]), np.zeros(3, int), np.zeros(3, int)]
    assert [p.tolist() for p in similar.meeting(none, 0.8)] == [[[4, 2, 3], [2, 2, 2]]]
    assert [similar.prefix(n, 0.8) for n in (0, 1, 4, 5, 10)] == [0, 1, 1, 2, 3]


def test_pairs_to_check_grow_with_the_texts_not_with_the_square_of_a_group(spark, monkeypatch):
    rng = random.Random(21)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
    texts = []
    for n in range(200):  # one word changed: alike; three others: most overlap with the rest by 0.76 or less
        words = list(base)
        for i in rng.sample(range(5, 70), 1) if n % 2 else rng.sample(range(75, 145, 10), 3):
            words[i] = f"n{n}"
        texts.append(" ".join(words))
    lots, checked = [], similar._checked

    def counted(found, *how):
        lots.append(found.count())
        return checked(found, *how)

    monkeypatch.setattr(similar, "_checked", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = {r.id: r.root for r in similar.similar(docs).collect()}
    assert sum(lots[1:]) < 10 * len(texts)  # the first lot is that of the fingerprints
    # All pairs, compared in plain Python.
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                group = [group[i] if g == group[j] else g for g in group]
    assert 20 < len(set(group)) == len(set(roots.values())) == len({(group[i], root) for i, root in roots.items()})


def test_sketches_bound_what_only_one_text_has():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[: 2 * n], n)) for n in (1, 3, 20, 30, 40, 200, 900, 2000, 3000)] + [np.empty(0, np.uint64)]
    sketches = np.array([similar.sketch(s) for s in sets], object)
    assert {len(s) * 8 for s in sketches} >= {64, 128, 1024, 4096}
    one, two = (x.ravel() for x in np.indices((len(sets), len(sets))))
    found = similar.differing(similar.folded(sketches), one, two, 7)
    assert all(0 <= d <= len(np.setxor1d(sets[i], sets[j])) for i, j, d in zip(one, two, found))
    assert not found[one == two].any() and (found[one != two] > 0).mean() > 0.9


def test_a_long_run_gives_the_nearest_first_then_all_that_fit():
    n = 100
    sets = [np.unique(np.r_[np.arange(100), 1000 + 20 * i + np.arange(i % 20)]).astype(np.uint64) for i in range(n)]
    sketches = [similar.sketch(s) for s in sets]
    columns = [np.full(n, 7), np.arange(n), np.where(np.arange(n) % 4, np.arange(n), 0), np.array([len(s) for s in sets], np.int32), np.zeros(n, np.int32)]
    names = ["key", "node", "root", "size", "place", "sketch"]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(sketches, pa.binary())], names=names)

    def pairs(nearest):
        return {p for b in similar._fitting(0.8, nearest)(iter([batch])) for p in zip(b["node"].to_pylist(), b["other"].to_pylist())}

    roots = columns[2]
    alike = {(a, b) for a in range(n) for b in range(a) if roots[a] != roots[b] and similar.overlap(sets[a], sets[b]) >= 0.8}
    assert alike and alike <= pairs(None)
    assert pairs(2) <= pairs(None) and n / 2 < len(pairs(2)) <= 2 * n < len(alike)
