"""State by shard pointers: what a batch reads and writes, and versions that die half-way."""

import pytest
from pyspark.sql import functions as F

from ranklake.functions.hashing import assign_shard
from ranklake.session import delete_path, match_paths, scratch_path
from ranklake.sinks import tables, versions
from ranklake.streaming import files as streams

SHARDS = 4


@pytest.fixture
def state(spark):
    root = scratch_path(spark, "versions")
    rows = assign_shard(spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("done")), "k", SHARDS)
    tables.write_state(rows, root, "000")
    return root, rows.schema


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def done(spark, root, schema):
    found = versions.read_shards(spark, root, schema)
    assert found.count() == found.select("k").distinct().count() == 40
    return sorted(r.k for r in found.where("done = 1").collect())


def shard(spark, k):
    return assign_shard(keys(spark, k), "k", SHARDS).first().shard_id


def test_a_batch_rewrites_only_the_shards_that_arrive(spark, state):
    root, schema = state
    step = streams.mark_shards(root, schema, "k", {"done": 1}, SHARDS)
    step(keys(spark, "7", "7"), 0)
    assert done(spark, root, schema) == ["7"]
    own = shard(spark, "7")
    assert [int(p.rsplit("=", 1)[1]) for p in match_paths(spark, f"{root}/part=*/shard_id=*")] == [own]
    named = versions.pointers(spark, root)
    assert {s for s, part in named.items() if part == "run=000"} == set(range(SHARDS)) - {own}
    other = next(str(i) for i in range(40) if shard(spark, str(i)) != own)
    step(keys(spark, other), 1)
    assert done(spark, root, schema) == sorted(["7", other]) and versions.pointers(spark, root)[own] == named[own]
    only = versions.read_shards(spark, root, schema, [own])
    assert {r.shard_id for r in only.collect()} == {own}
    assert all(f"shard_id={own}/" in f for f in only.inputFiles() if "/part=" in f) and not any("run=" in f for f in only.inputFiles())


def test_repeated_empty_and_unknown_batches(spark, state):
    root, schema = state
    step = streams.mark_shards(root, schema, "k", {"done": 1}, SHARDS)
    for _ in range(2):
        step(keys(spark, "1", "2", "3"), 0)
    assert done(spark, root, schema) == ["1", "2", "3"]
    step(keys(spark).limit(0), 1)
    assert len(match_paths(spark, f"{root}/version=*")) == 1
    step(keys(spark, None, "none"), 2)
    assert done(spark, root, schema) == ["1", "2", "3"]


def test_a_torn_version_is_never_read(spark, state, monkeypatch):
    root, schema = state
    step = streams.mark_shards(root, schema, "k", {"done": 1}, SHARDS)
    step(keys(spark, "1"), 0)
    # The part is whole, but the run dies before the pointers; then with pointers but no record that they are all there.
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)
    batch = create(spark, [("1",), ("5",)], "k string")
    with pytest.raises(ZeroDivisionError):
        step(batch, 1)
    monkeypatch.undo()
    assert len(match_paths(spark, f"{root}/part=*")) == 2 and done(spark, root, schema) == ["1"]
    create(spark, [(0, "part=gone")], "shard int, part string").write.parquet(f"{root}/version=batch-000000000001")
    assert delete_path(spark, f"{root}/version=batch-000000000001/_SUCCESS")
    assert done(spark, root, schema) == ["1"]
    step(batch, 1)
    assert done(spark, root, schema) == ["1", "5"]


def test_old_versions_go_and_named_parts_stay(spark, state):
    root, schema = state
    step = streams.mark_shards(root, schema, "k", {"done": 1}, SHARDS)
    for batch in range(5):
        step(keys(spark, str(batch)), batch)
    before = done(spark, root, schema)
    assert versions.drop_old_versions(spark, root, keep=1) >= 4
    assert done(spark, root, schema) == before == ["0", "1", "2", "3", "4"]
    assert len(match_paths(spark, f"{root}/version=*")) == 1
    assert len(match_paths(spark, f"{root}/part=*")) == len({p for p in versions.pointers(spark, root).values() if p.startswith("part=")})


def test_a_shard_without_rows_is_gone_and_a_foreign_row_is_an_error(spark, state):
    root, schema = state
    rows = versions.read_shards(spark, root, schema)
    with pytest.raises(ValueError, match="rows of shards"):
        versions.write_shards(rows, root, "001", [0])
    versions.write_shards(rows.limit(0), root, "002", [0])
    assert 0 not in versions.pointers(spark, root) and set(versions.pointers(spark, root)) == {1, 2, 3}
    assert versions.pointers(spark, scratch_path(spark, "none")) == {}
