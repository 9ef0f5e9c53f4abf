import re

import pytest

from ranklake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return len(WORD.findall(text or ""))


def level(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by handing out what is left again and again until nobody is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        given = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, more in given.items():
            target[s] += more
            over = target[s] - most * sizes[s]
            if over >= 0:
                target[s] -= over
                left += over
                open_.discard(s)
    return target


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else [None, "a", "b", "Ä", "", "tiny"][i % 6]
        rows.append((i, " ".join(["w"] * (i * 7 % 50)) + "\t\n", source, i, 0.5))
    rows += [(300, None, "a", 0, 0.5), (301, "", "only empty", 0, 0.5), (None, "x y z", "a", 0, 0.5), (5, "same same", "b", 0, 0.5), (5, "same same", "b", 0, 0.5)]
    rows += [(400, "long " * 9000, "b", 0, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, target double")


def test_targets_and_takes(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 300, 3)] + [(0, 1), (3, None)], "doc_id long, quality int")
    found = mixing.mix(docs, quality=labels).collect()
    rows = docs.collect()
    assert len(found) == len(rows)
    assert sorted(((r.doc_id or -1), r.size) for r in found) == sorted(((r.doc_id or -1), words(r.text)) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    want = level(sizes)
    for source in sizes:
        own = [r for r in found if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(want[source])
        assert abs(sum(r.taken for r in own) - want[source]) <= 0.5 + 1e-6
        assert all(0 <= r.taken <= 2 * r.size for r in own)
        parts = [r for r in own if 0 < r.extra < r.size]
        assert len(parts) <= 1
    again = mixing.mix(docs.repartition(7), quality=labels).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "one two three", "s") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, quality int")
    taken = mixing.mix(docs, share=0.4, quality=labels).where("taken > 0").selectExpr("doc_id % 2 = 1 AS good").collect()
    good = sum(r.good for r in taken)
    assert 780 <= len(taken) <= 820 and good / len(taken) > 0.65


def test_mixed_documents(spark, docs):
    unique = docs.where("doc_id IS NOT NULL AND doc_id <> 5")
    lot = {r.doc_id: r for r in mixing.mix(unique).collect()}
    found = mixing.mixed_documents(unique)
    assert found.columns == docs.columns
    text = {r.doc_id: r.text for r in unique.collect()}
    got = {}
    for r in found.collect():
        assert text[r.doc_id].startswith(r.text)
        got.setdefault(r.doc_id, []).append(words(r.text))
    assert {k: sum(v) for k, v in got.items()} == {k: r.taken for k, r in lot.items() if r.taken}


def test_empty_table(spark, docs):
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.mixed_documents(docs.limit(0)).collect() == []
