import hashlib
import re

import pytest

from ranklake.llm import exact

TEXTS = ["a b", "a  b", "a\t\nb", " a b", "a b ", "", None, " ", "\n", "x" * 5000, "x" * 5000, "x" * 4999 + "y", "y" * 70 + "1", "y" * 70 + "2", "é é", "é é", "alone"]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def rows():
    out = [(len(TEXTS) - i, t) for i, t in enumerate(TEXTS)]
    return out + [(None, "a b"), (None, "nobody"), (None, "nobody"), (3, "twice"), (3, "twice"), (50, "twice")]


@pytest.mark.parametrize("digest_all", [True, False])
def test_against_plain(spark, rows, digest_all):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, group_size int")
    found = exact.mark_copies(docs, digest_all=digest_all).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256(norm(t).encode()).hexdigest()
        want.append((i, keep, len(ids), digest if digest_all or len(ids) > 1 else None))
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    if not digest_all:  # a text whose length and prefix are shared was read, so its digest may be there
        digests = {hashlib.sha256(norm(t).encode()).hexdigest() for _, t in rows}
        assert all(d is None or d in digests for *_, d in got)
        assert sum(d is None for *_, d in got) > 0
        got, want = ([x[:3] for x in rows_] for rows_ in (got, want))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = [(r.keep_id, r.group_size) for r in found if r.kept]
    assert len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_drop_copies(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _extra string")
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, norm(r.text)) for r in left.collect()]
    assert len(got) == len({t for _, t in got}) == len({norm(t) for _, t in rows})
    for i, t in got:
        assert i == min((x for x, y in rows if norm(y) == t and x is not None), default=None)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact.mark_copies(none).collect() == [] and exact.drop_copies(none).collect() == []
