"""Queries with SQL agree with it; native ones stay free of Python and of joins over all pairs."""

from pathlib import Path

import pytest

from check import canonical
from ranklake.llm.queries import query

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the benchmark tables")


@pytest.fixture(scope="module")
def duck():
    base = pytest.importorskip("duckdb").connect()
    for file in FOLDER.glob("*.parquet"):
        base.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return base


@pytest.mark.parametrize("name", sorted(query.sql))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = query.queries[name](spark, str(FOLDER))
    result = duck.execute(query.sql[name])
    columns = [c[0] for c in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", ["op1_mixing", "op4_chat"])
def test_native_queries_run_no_python(spark, name):
    plan = query.queries[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("EvalPython", "InArrow", "InPandas", "CartesianProduct", "NestedLoop"))


def test_pieces_of_op10_cover_their_documents(spark):
    rows = query.queries["op10_packing"](spark, str(FOLDER)).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for pieces in by_doc.values():
        end = 0
        for start, length, total in sorted(pieces):
            assert start == end
            end += length
        assert end == total
