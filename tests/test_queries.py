"""Every registered query has SQL, and those without files of their own agree with it."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import SAME_TYPE, canonical
from ranklake.workload import jobs, relations, tables, values

FOLDER = Path("/root/testdata/sf0.001")
PLAIN = [*values.query.queries, *relations.query.queries, "player_plan"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        base.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return base


def test_every_query_is_checked_and_reads_a_table():
    queries, sql = entry.queries(), entry.oracle_sql()
    own = {name for module in (values, relations, tables, jobs) for name in module.query.queries}
    assert own <= set(queries) and own <= set(sql) and set(sql) <= set(queries)
    names = "region|nation|customer|supplier|part|orders|lineitem|events|documents|embeddings|pages|benchmark|labels|conversations"
    for name, text in sql.items():
        assert re.search(rf"(?i)(from|join)\s*\(?\s*({names})\b", text), name


def test_entry(spark):
    assert entry.entry(spark).columns == ["puuid", "region", "platform", "last_read", "shard_id"]


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the benchmark tables")
@pytest.mark.parametrize("name", PLAIN)
def test_query_agrees_with_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(FOLDER))
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert {c[0]: SAME_TYPE.get(str(c[1])) for c in result.description} == dict(df.dtypes)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "MapInArrow", "MapInPandas"]


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the benchmark tables")
@pytest.mark.parametrize("name", PLAIN)
def test_plan_has_no_pair_join_and_no_python(spark, name):
    plan = entry.queries()[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the benchmark tables")
def test_scans_read_only_what_they_need(spark):
    plan = entry.queries()["player_plan"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "props" not in plan
    done = entry.queries()["mark_done"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in done and "o_totalprice" not in done and "l_tax" not in done


def test_jobs_are_registered():
    assert {"ladder_job", "player_job", "match_id_job", "match_plan_job", "match_job"} <= set(jobs.query.queries)
