import itertools
import random
import re

import pytest

from ranklake.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The filters that each row fails, told apart in plain Python."""
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        own = set()
        if len(words) < 200:
            own.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            own.add("C")
        if re.search(r"[#$%&*|]", text):
            own.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            own.add("E")
        out.append(own)
    return out


def plain(rows, labels):
    failed = fails(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed) if (r[2] or "") == part]
        shares = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shares[name] += len(gone)
                lines.append((
                    name, part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in own) - len(gone),
                    sum(f == {name} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ))
        out += [(*line, shares[name]) for name, *line in lines]
    return sorted(out)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_audit_against_plain_loops(spark, broadcast):
    rng = random.Random(4)
    words = ["aa", "B", "Cc", "d#", "é", "eee", "f g", "h i", "j|"] + [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words[: rng.choice([3, 8, 400])], k=rng.choice([0, 3, 199, 200, 260]))) for _ in range(60)]
    texts += [None, "", " ", "A", "$", "same", "same", "x\x0by" * 200, "Long " * 30_000]
    rows = [(i, t, rng.choice(["en", "de", None, ""]), 1) for i, t in enumerate(rng.choices(texts, k=150))]
    rows += [(None, "same", "en", 1), (3, "same", "fr", 1), (3, "same", "fr", 1), (-1, "", None, 1)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (None, 1, 1), (999, 1, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row int")
        found = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        assert sorted(tuple(r[n] for n in names) for r in found.collect()) == plain(rows, labels)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, labels).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    found = audit.audit(one, labels).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert {r.removed for r in found if r.filter_order[r.step - 1] == "A"} == {1}
    assert {r.shapley for r in found if r.filter_order[r.step - 1] == "A"} == {120}


def test_each_filter_leaves_a_table_of_rows(spark):
    docs = spark.createDataFrame([(2, "#", "a"), (1, "#", "a"), (None, "#", "b")], "doc_id long, text string, lang string")
    rows, tables = audit.failing(docs)
    assert list(tables) == list("ABCDE")
    ids = {r.row: r.doc_id for r in rows.collect()}
    assert [ids[r.row] for r in tables["E"].collect()] == [2]
    assert tables["D"].count() == 3 and tables["C"].count() == 0
