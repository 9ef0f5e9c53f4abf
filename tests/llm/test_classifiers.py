"""Language identification and toxicity: parts against plain versions, the whole on held-out rows."""

import math
import os
from collections import Counter

import numpy as np
import pytest

from ranklake.llm import langid, toxicity
from ranklake.llm import queries as q

FOLDER = "/root/testdata/sf0.01"


def test_support_vectors_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    w = langid.fit(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = ("Der schnelle braune Fuchs " * 50).encode()
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_PIECE", 100)
    assert np.allclose(whole, langid.features(text)) and np.isclose(np.linalg.norm(whole), 1)
    assert np.isfinite(langid.features(b"")).all()


def test_languages_by_family(spark):
    words = {"de": "der und nicht ein", "en": "the and not one", "fr": "les pas une être", "es": "los pero una está", "xx": "qqq zzz kkk"}
    rows = [(i, f"{words[v]} {i}", v, "s") for i, v in enumerate(list(words) * 40)]
    rows += [(1000, None, "de", "s"), (1001, "123 !", "de", "s"), (1002, "", None, "s"), (None, "the and not", "en", "s"), (1003, "der und " * 40000, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.learn(docs)
    assert model.families == ["germanic", "romance", "xx"] and model.languages["germanic"] == ["de", "en"]
    found = {(r.doc_id): r for r in langid.identify(docs, model).collect()}
    assert all(found[i].lang_pred == v for i, _, v, _ in rows[:200])
    assert [(found[i].lang_pred, found[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert found[None].lang_pred == "en" and not found[None].held_out and found[1003].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found.values())
    left = langid.drop_unknown(docs, model)
    assert left.columns == docs.columns and left.count() == len(rows) - 3


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, langid.learn(docs)).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0), None).collect() == []


def plain_grams(text, order=7):
    out = []
    for word in "".join(c if c.isalpha() or c == "'" else " " for c in text).split():
        shown = f" {word} "
        out += [shown[max(0, i - order + 1) : i + 1] for i in range(1, len(shown))]
    return out


@pytest.mark.parametrize("text", ["", " ", "a", "ab  cdefghijk!x", "  lead and trail  ", "it's\na tab\t", "1 2 3"])
def test_grams(text):
    found, starts = toxicity.grams(text.encode())
    shown = [int(g).to_bytes(8, "big").lstrip(b"\0").decode() for g in found]
    assert shown == plain_grams(text)
    assert len(starts) == len("".join(c if c.isalpha() or c == "'" else " " for c in text).split())


def test_log_ratios_against_plain(spark):
    texts = [(0, "the cat sat on the mat"), (0, "the dog ate the cat"), (1, "the idiot cat"), (1, "idiot idiot dog")]
    count = [Counter(), Counter()]
    for toxic, t in texts:
        count[toxic].update(plain_grams(t))
    number = lambda g: int.from_bytes(g.encode(), "big")
    every = sorted(set(count[0]) | set(count[1]))
    frame = spark.createDataFrame([(number(g), count[0][g], count[1][g]) for g in every], "gram long, ordinary long, toxic long")
    found = {r.gram: r.ratio for r in toxicity.log_ratios(frame).collect()}
    d = toxicity.DISCOUNT
    kinds = {g[i:] for g in every for i in range(len(g))}  # of every order

    def low(g):
        """Probability of the last character, from how many characters stand before each n-gram."""
        if not g:
            return 1 / 64
        before = lambda h: len({k for k in kinds if k[1:] == h})
        same = [h for h in kinds if h[:-1] == g[:-1] and len(h) == len(g) and before(h)]
        return (max(before(g) - d, 0) + d * len(same) * low(g[1:])) / sum(map(before, same))

    for g in every:
        same = [h for h in every if h[:-1] == g[:-1] and len(h) == len(g)]
        n = lambda h: count[0][h] + count[1][h]
        shared = (max(n(g) - d, 0) + d * len(same) * low(g[1:])) / sum(map(n, same))

        def of(c):
            total, kinds = sum(c[h] for h in same), sum(c[h] > 0 for h in same)
            return (max(c[g] - d, 0) + d * kinds * shared) / total if total else shared

        assert found[number(g)] == pytest.approx(math.log(of(count[1])) - math.log(of(count[0])))


def test_toxic_words_are_learnt(spark):
    rows = [(i, ("Quiet words about the river and hills " * (1 + i % 5)) + ("you IDIOT" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "idiot " * 30000), (None, "the river")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(0, None), (0, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert all(found[i].predicted == int(i % 4 == 0) for i in range(400))
    assert found[1000].score == found[1001].score and found[1002].predicted == 1 and found[None].predicted == 0
    nothing = toxicity.learn(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}
    assert toxicity.score(docs.limit(0), nothing).collect() == []


@pytest.mark.parametrize("held", [1 << 22, 40, 0])
def test_measures_against_plain(spark, monkeypatch, held):
    texts = [(0, "the cat sat on the mat"), (0, "the dog ate the cat"), (1, "the idiot cat"), (1, "idiot idiot dog")]
    count = [Counter(), Counter()]
    for toxic, t in texts:
        count[toxic].update(plain_grams(t))
    number = lambda g: int.from_bytes(g.encode(), "big")
    every = sorted(set(count[0]) | set(count[1]))
    frame = spark.createDataFrame([(number(g), count[0][g], count[1][g]) for g in every], "gram long, ordinary long, toxic long")
    exact = {r.gram: r.ratio for r in toxicity.log_ratios(frame).collect()}

    def ratio(g):
        if number(g) in exact:
            return exact[number(g)]
        kept_back = []
        for c in count:
            after = [n for h, n in c.items() if h[:-1] == g[:-1]]
            kept_back.append(toxicity.DISCOUNT * len(after) / sum(after) if after else 1.0)
        return math.log(kept_back[1] / kept_back[0])

    asked = ["the idiot sat", "", "then idiots dogged catty idiots zebra then", "idiotic", "the the the", "aaaaaaaaaa the caaaaaaaaat"]
    monkeypatch.setattr(toxicity, "HELD", held)
    model = toxicity.ratios(frame)
    assert (model.every is None) == (held > 1000) and len(model.grams) <= held
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").selectExpr("doc_id", "cast(text AS binary) AS text")
    found = {r.doc_id: r.measures for r in toxicity.measured(rows, model).collect()}
    for i, text in enumerate(asked):
        sums = sorted((sum(map(ratio, plain_grams(w))) for w in text.split()), reverse=True)
        n = len(sums)
        assert found[i] == pytest.approx([sum(sums) / max(n, 1), sums[0] if n else 0, sum(sums[:3]) / 3, math.log1p(n)])


def test_all_labelled_rows_are_counted(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "ab cd") for i in range(400)] + [(5, "ab cd")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    seen, plain = [], toxicity.log_ratios
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 20, raising=False)
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 20)
    monkeypatch.setattr(toxicity, "log_ratios", lambda c: (seen.append(c.selectExpr("sum(ordinary + toxic)").first()[0]), plain(c))[1])
    toxicity.learn(docs, labels)
    counted = docs.where("doc_id < 300 AND crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2").count()
    assert seen[-1] == 6 * counted and counted > 200


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the benchmark tables")
def test_held_out_languages(spark):
    found = q.op9_langid(spark, FOLDER)
    docs = q.table(spark, FOLDER, "documents").select("doc_id", "lang")
    held = found.where("held_out AND lang_pred <> 'und'").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
