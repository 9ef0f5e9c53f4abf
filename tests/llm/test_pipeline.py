"""The stages against plain versions, each on what its predecessor really kept."""

import random
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ranklake.session import scratch_path, settle

WORDS = {"de": "der und nicht ein Haus", "en": "the and not one house", "fr": "les pas une être maison"}


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(4)
    rows = []
    for i in range(160):
        lang = rng.choice(list(WORDS))
        text = " ".join(rng.choice(WORDS[lang].split()) + str(rng.randint(0, 400)) for _ in range(rng.randint(3, 150)))
        rows.append((i, text, lang, rng.choice(["a", "a", "b", None])))
    rows += [(200 + i, rows[i][1].replace(" ", " \n"), rows[i][2], "b") for i in range(20)]
    rows += [(300 + i, rows[40 + i][1] + " end", rows[40 + i][2], "c") for i in range(30)]
    rows += [(400, None, None, "a"), (401, "", None, "a"), (402, "12 34 !", None, "a"), (5, rows[5][1], "de", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    path = scratch_path(spark, "pipeline-input")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def linked_by_shingles(texts):
    """Groups of texts that chains of five-word overlaps of 0.8 join, by comparing all pairs."""
    sets = []
    for text in texts:
        words = text.lower().split()
        sets.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            every = len(sets[i] | sets[j])
            if group[i] != group[j] and (not every or len(sets[i] & sets[j]) / every >= 0.8):
                group = [group[i] if g == group[j] else g for g in group]
    return group


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, folder), "stage")
        seen.append(docs.collect())
        if name != "packing":
            assert docs.columns == columns
    raw, named, exact, near, mixed, packed = seen

    assert sorted(r.doc_id for r in named) == sorted(r.doc_id for r in raw if re.search(r"[^\W\d_]", r.text or ""))
    first = {}
    for r in named:
        first[norm(r.text)] = min(r.doc_id, first.get(norm(r.text), r.doc_id))
    assert sorted((r.doc_id, norm(r.text)) for r in exact) == sorted((i, t) for t, i in first.items())
    groups = linked_by_shingles([r.text for r in exact])
    least = {}
    for r, g in zip(exact, groups):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    # Nothing goes that has no such neighbour; few of the others are missed, as fingerprints find the candidates.
    stay = {r.doc_id for r in near}
    assert len(near) == len(stay) and stay >= set(least.values())
    assert len(exact) - len(stay) >= 0.9 * (len(exact) - len(least)) > 0
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert abs(words(mixed) - 1.5 * words(near)) <= 4
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    assert all(r.n_chars == len(r.text) for r in mixed)
    ids = {}
    for p in packed:
        if p.start == 0:
            ids[p.doc_id] = ids.get(p.doc_id, 0) + 1
    wanted = {}
    for r in mixed:
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + 1
    assert ids == wanted


def test_run_and_registration(spark, folder):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 0 and "sequence_id" in found.columns


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in names) == 1 for n in range(1, 14))


def test_empty_documents(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = settle(stage(spark, none, folder), "stage")
    assert none.count() == 0


def test_stages_leave_columns_of_any_name_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    names = ["_id", "_full", "_text", "_words", "_take", "_size", "_id_0", "_full_0", "_node_0", "node", "_of_key", "row", "root", "fp"]
    for name in names:
        docs = docs.withColumn(name, corpus_pipeline_label(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns
        told = found.select(*names).distinct().collect()
        assert [list(r) for r in told] == [[f"mine {n}" for n in names]]


def corpus_pipeline_label(name):
    from pyspark.sql import functions as F

    return F.lit(f"mine {name}")
