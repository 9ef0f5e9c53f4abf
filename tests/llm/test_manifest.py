import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ranklake.llm import manifest


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    said = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*said)


def grow(level):
    """Levels of a tree from its rows up, and the run of each node below the top."""
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def beside(levels, i):
    path = []
    for level in levels[:-1]:
        run = i // 8 * 8
        path.append(("".join(level[run:i]), "".join(level[i + 1 : run + 8])))
        i //= 8
    return path


def plain(rows):
    """(doc_id, leaf, subroot, root, path) of rows of (doc_id, source, lang, n_chars, text)."""
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for name in names:
        parts[name].sort(key=lambda x: x[:3])
        trees[name] = grow([x[2] for x in parts[name]])
    top = grow([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(parts[name]):
            out.append((row[0], own, trees[name][-1][0], top[-1][0], beside(trees[name], i) + beside(top, at)))
    return out


def rows_of(n, seed, langs):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", None, "é"]), rng.choice(langs), rng.choice([None, 3]), rng.choice(["x", "Big É", "", None])) for i in range(n)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path string, root int"


@pytest.mark.parametrize(("n", "levels"), [(1, 4), (8, 1), (9, 1), (65, 1), (64, 2), (130, 2), (30, 4)])
def test_trees_and_proofs(spark, monkeypatch, n, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    rows = rows_of(n, n, ["en"] if n in (8, 9, 64, 65) else ["en", "de", None, "", "É", "z"])
    docs = spark.createDataFrame([(*r, "mine", 5) for r in rows], SCHEMA)
    found = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in manifest.manifest(docs).collect()]
    assert sorted(found) == sorted(plain(rows))


def test_many_parts_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    rows = rows_of(120, 5, [f"l{i}" for i in range(20)]) + [(None, None, None, None, None)] * 3 + [(7, "a", "l1", 1, "t")] * 12
    docs = spark.createDataFrame([(*r, "mine", 5) for r in rows], SCHEMA).repartition(5)
    found = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in manifest.manifest(docs).collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)


def test_claims_that_differ_do_not_lead_to_the_root(spark):
    rows = rows_of(90, 2, ["en", "fr"])
    docs = spark.createDataFrame([(*r, "mine", 5) for r in rows], SCHEMA)
    lowered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    found = manifest.manifest(docs, claimed={"text": lowered})
    told = found.select("doc_id", "root", "path", "leaf", manifest.folded(F.coalesce("claimed_leaf", "leaf")).alias("folded"), manifest.proof_digest().alias("proof"))
    text = {r[0]: r[4] for r in rows}
    want = {r[0]: r for r in plain(rows)}
    for r in told.collect():
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text[r.doc_id] not in (None, (text[r.doc_id] or "").lower())
        assert (r.folded == r.root) == (not changed)
        assert r.proof == h(*[b + a for b, a in want[r.doc_id][4]])


def test_empty_table(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_joins_below_the_ranking(spark):
    docs = spark.createDataFrame([(*r, "mine", 5) for r in rows_of(40, 1, ["en", "fr"])], SCHEMA)
    plan = manifest.manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
