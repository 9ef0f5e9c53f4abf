from datetime import date

import pytest
from pyspark.sql import functions as F

from ranklake.operators.numbering import split_even
from ranklake.plans import registry
from ranklake.schemas import MATCH_IDS, PLAYER_STATE, RESUME
from ranklake.session import scratch_path
from ranklake.sinks import resume, staging, tables
from ranklake.sources import files, pages, parquet
from ranklake.streaming import files as streams

IDS = "match_id string, is_ingested int"


def test_scan_of_nothing_is_empty(spark):
    empty = parquet.scan(spark, scratch_path(spark, "none"), MATCH_IDS)
    assert empty.columns == MATCH_IDS.names and empty.isEmpty()
    assert parquet.scan_table(spark, scratch_path(spark, "none"), MATCH_IDS).isEmpty()


def test_scan_takes_parquet_files_at_any_depth(spark, rows):
    path = scratch_path(spark, "deep")
    df = spark.createDataFrame([("a", 0)], IDS)
    df.write.parquet(f"{path}/x/y")
    df.write.parquet(f"{path}/z")
    df.write.json(f"{path}/other")
    assert rows(parquet.scan(spark, path, df.schema)) == [("a", 0)] * 2
    sourced = parquet.scan_with_source(spark, path, df.schema)
    assert sourced.select("source_file_path").distinct().count() == 2


def test_tolerant_scan(spark, rows):
    path = scratch_path(spark, "tolerant")
    spark.createDataFrame([("a", 1), ("b", None)], IDS).write.parquet(f"{path}/one")
    spark.createDataFrame([("c",)], "match_id string").write.parquet(f"{path}/two")
    schema = spark.createDataFrame([], IDS).schema
    got = parquet.scan_tolerant(spark, path, schema, {"is_ingested": 0})
    assert rows(got) == [("a", 1), ("b", 0), ("c", 0)]
    assert rows(parquet.scan_tolerant(spark, path, schema)) == sorted([("a", 1), ("b", None), ("c", None)], key=repr)


def test_tolerant_scan_skips_an_unreadable_file(spark, rows, tmp_path):
    spark.createDataFrame([("a", 1)], IDS).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad.parquet").write_bytes(b"this is no parquet file, but long enough to look at")
    schema = spark.createDataFrame([], IDS).schema
    assert rows(parquet.scan_tolerant(spark, str(tmp_path), schema, skip_corrupt=True)) == [("a", 1)]
    with pytest.raises(Exception):
        parquet.scan_tolerant(spark, str(tmp_path), schema).collect()


def test_concat(spark, rows):
    a = spark.createDataFrame([("a", 1)], IDS)
    b = spark.createDataFrame([("b",)], "match_id string")
    assert parquet.concat_strict([], spark, a.schema).isEmpty()
    with pytest.raises(Exception):
        parquet.concat_strict([a, b], spark, a.schema).collect()
    assert rows(parquet.concat_tolerant([a, b], spark, a.schema, {"is_ingested": 0})) == [("a", 1), ("b", 0)]


def test_last_shard_wins(spark, rows):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), 0), ("a", None, 3), ("", None, 1), (None, None, 1), ("b", None, 2)],
        "puuid string, last_read date, shard_id int",
    )
    assert rows(parquet.last_shard_wins(df, "puuid")) == sorted([("a", None, 3), ("b", None, 2)], key=repr)


def test_pages_stop_at_the_first_empty_or_failed_page(spark, rows):
    data = [
        ("a", 1, 200, ["x"]), ("a", 2, 200, []), ("a", 3, 200, ["never"]),
        ("b", 1, 200, []), ("b", 2, 200, ["never"]),
        ("c", 1, 200, ["x", "y"]), ("c", 2, 429, ["never"]), ("c", 3, 200, ["never"]),
        ("d", 1, 200, ["x"]), ("d", 2, 200, None), (None, 1, 200, ["n"]), (None, 2, 200, []), (None, 3, 200, ["never"]),
    ]
    df = spark.createDataFrame(data, "k string, page int, status int, entries array<string>")
    got = pages.pages_until_empty(df, ["k"], status="status")
    want = [("a", 1, "x"), ("c", 1, "x"), ("c", 1, "y"), ("d", 1, "x"), (None, 1, "n")]
    assert rows(got, "k", "page", "entry") == sorted(want, key=repr)


def test_explode_ids_numbers_the_whole_list(spark, rows):
    df = spark.createDataFrame([("p", 0, ["a", "b"]), ("p", 100, ["c"]), ("q", 0, [])], "puuid string, start long, ids array<string>")
    assert rows(pages.explode_ids(df)) == [("p", 0, "a"), ("p", 1, "b"), ("p", 100, "c")]


def test_key_outcomes_take_the_first_failure(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 200, None), ("a", 2, 429, "7"), ("a", 3, 500, None), ("b", 1, 200, None)],
        "k string, page int, status int, retry_after string",
    )
    assert rows(pages.key_outcomes(df, ["k"])) == sorted([("a", "rate_limited", 7.0), ("b", "ok", None)], key=repr)


def test_overwrite_leaves_other_partitions(spark, rows):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([("a", 0), ("b", 1)], "k string, shard_id int")
    tables.write_partitioned(df, path, ["shard_id"])
    tables.overwrite_partitions(spark.createDataFrame([("c", 1)], "k string, shard_id int"), path, ["shard_id"])
    assert rows(parquet.scan_table(spark, path, df.schema)) == [("a", 0), ("c", 1)]


def test_rows_per_file_and_per_group(spark):
    import pyarrow.parquet as pq

    path = scratch_path(spark, "groups")
    tables.write_partitioned(spark.range(2500).withColumn("g", F.lit(1)), path, ["g"], rows_per_file=2000, rows_per_group=1000)
    listed = files.list_files(spark, path).collect()
    sizes = []
    for row in listed:
        meta = pq.ParquetFile(row["file_path"].replace("file:", "")).metadata
        sizes.append([meta.row_group(i).num_rows for i in range(meta.num_row_groups)])
    assert sorted(sizes) == [[500], [1000, 1000]]


def test_state_runs_are_read_newest_first_and_only_when_complete(spark, rows):
    root = scratch_path(spark, "state")
    schema = "puuid string, last_read date, region string, platform string, shard_id int"
    first = spark.createDataFrame([("a", None, "r", "p", 0)], schema)
    second = spark.createDataFrame([("b", None, "r", "p", 1)], schema)
    assert tables.newest_state(spark, root, PLAYER_STATE).isEmpty()
    tables.write_state(first, root, "1")
    tables.write_state(second, root, "2")
    second.write.parquet(f"{root}/run=3")
    from ranklake.session import delete_path

    delete_path(spark, f"{root}/run=3/_SUCCESS")
    assert rows(tables.newest_state(spark, root, PLAYER_STATE), "puuid") == [("b",)]
    assert rows(tables.newest_state(spark, root, PLAYER_STATE, before="2"), "puuid") == [("a",)]
    tables.drop_old_state(spark, root, keep=1)
    assert len(tables.state_runs(spark, root)) == 1


def test_staging_round_trip(spark, rows):
    root = scratch_path(spark, "stage")
    df = spark.createDataFrame([("a", 0)], IDS)
    with pytest.raises(staging.StageNotFound):
        staging.restore(spark, root, "b", "j", df.schema)
    staging.stage(df, root, "b", "j")
    assert rows(staging.restore(spark, root, "b", "j", df.schema)) == [("a", 0)]
    assert rows(staging.with_staged(df, root, "b", "j")) == [("a", 0)] * 2
    assert staging.drop_stage(spark, root, "b", "j")
    assert rows(staging.with_staged(df, root, "b", "j")) == [("a", 0)]


def test_resume_ledger_round_trip(spark, rows):
    root = scratch_path(spark, "resume")
    with pytest.raises(resume.ResumeNotFound):
        resume.load_resume(spark, root, "b", "j")
    assert not resume.has_resume(spark, root, "b", "j")
    left = split_even(spark.range(5), 2, ["id"])
    ledger = resume.resume_rows(left, "id", "b", "j", 3.0, "2024-01-01T00:00:00", "some/path", 1)
    assert ledger.columns == RESUME.names
    resume.save_resume(ledger, root)
    resume.save_resume(resume.resume_rows(left.where("part = 0"), "id", "c", "j", None, "2024-01-01"), root)
    got = resume.load_resume(spark, root, "b", "j")
    assert rows(got, "part", "item", "staging_path", "retry_after_seconds") == [
        (0, "0", "some/path", 3.0), (0, "1", "some/path", 3.0), (0, "2", "some/path", 3.0),
        (1, "3", "some/path", 3.0), (1, "4", "some/path", 3.0),
    ]
    assert resume.clear_resume(spark, root, "b", "j")
    assert not resume.has_resume(spark, root, "b", "j")
    assert resume.has_resume(spark, root, "c", "j")


def test_registry_is_idempotent_and_ignores_other_files(spark, rows):
    base = scratch_path(spark, "registry")
    path, ledger = f"{base}/data", f"{base}/ledger"
    spark.range(3).coalesce(1).write.parquet(path)
    spark.range(3).write.json(f"{path}/notes")
    assert registry.current_snapshot(registry.read_ledger(spark, ledger), "t") == 0
    assert registry.register(spark, ledger, "t", path, "2024-01-01") == 1
    assert registry.register(spark, ledger, "t", path, "2024-01-01") == 1
    spark.range(4).coalesce(1).write.mode("append").parquet(path)
    assert registry.register(spark, ledger, "t", path, "2024-01-02") == 2
    assert registry.register(spark, ledger, "u", path, "2024-01-02") == 1
    entries = registry.read_ledger(spark, ledger)
    assert rows(entries, "table_name", "snapshot_id", "record_count") == [
        ("t", 1, 3), ("t", 2, 4), ("u", 1, 3), ("u", 1, 4),
    ]
    assert entries.where("bytes <= 0").isEmpty()


def test_stream_reads_each_file_once_and_appends_each_key_once(spark, rows):
    base = scratch_path(spark, "stream")
    schema = spark.range(1).schema
    spark.range(5).coalesce(1).write.parquet(f"{base}/in")
    step = streams.append_unseen(f"{base}/out", schema, ["id"])

    def run():
        streams.run_to_end(streams.stream_new(spark, f"{base}/in", schema, 1), step, f"{base}/checkpoint")
        return rows(parquet.scan(spark, f"{base}/out", schema))

    assert run() == [(i,) for i in range(5)]
    spark.range(3, 8).coalesce(1).write.mode("append").parquet(f"{base}/in")
    spark.range(6, 9).coalesce(1).write.mode("append").parquet(f"{base}/in")
    assert run() == run() == [(i,) for i in range(9)]


def test_a_repeated_batch_changes_nothing(spark, rows):
    base = scratch_path(spark, "repeat")
    schema = spark.createDataFrame([], "k string, done int, shard_id int").schema
    tables.write_state(spark.createDataFrame([("a", 0, 0), ("b", 0, 1)], schema), base, "000")
    step = streams.mark_state(base, schema, "k", {"done": 1})
    for _ in range(2):
        step(spark.createDataFrame([("a",)], "k string"), 0)
    assert rows(tables.newest_state(spark, base, schema), "k", "done") == [("a", 1), ("b", 0)]


def test_landed_json(spark, rows, tmp_path):
    from ranklake.schemas import LADDER_PAGES

    assert pages.read_landed(spark, str(tmp_path / "none"), LADDER_PAGES).isEmpty()
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"platform": "kr", "page": 1, "entries": [{"puuid": "p", "wins": 3}]}\n')
    got = pages.explode_entries(pages.read_landed(spark, str(folder), LADDER_PAGES))
    assert rows(got, "platform", "tier", "entry.puuid", "entry.wins", "entry.losses") == [("kr", None, "p", 3, None)]
    (folder / "b.json").write_text("{broken\n")
    with pytest.raises(Exception):
        pages.read_landed(spark, str(folder), LADDER_PAGES).collect()
    assert rows(pages.read_landed(spark, str(folder), LADDER_PAGES, tolerant=True), "platform") == [("kr",)]


def test_bare_value_layout_is_read_back_into_columns(spark, rows):
    from ranklake.functions.layout import with_path_columns

    base = scratch_path(spark, "bare")
    df = spark.createDataFrame([("a", 0)], IDS)
    df.coalesce(1).write.parquet(f"{base}/league/asia/kr/gold/all")
    found = parquet.scan_with_source(spark, f"{base}/league", df.schema)
    got = with_path_columns(found, ["region", "platform", "tier", "division"])
    assert rows(got, "match_id", "region", "platform", "tier", "division") == [("a", "asia", "kr", "gold", "all")]


def test_small_row_groups_are_bounded_in_a_file(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(tables, "GROUPS_PER_FILE", 3)
    name, path = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "groups")
    before = spark.conf.get(name)
    df = spark.range(1000).selectExpr("id % 3 AS part", "id")
    tables.write_partitioned(df, path, ["part"], rows_per_group=10)
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "groups").rglob("*.parquet")]
    assert spark.conf.get(name) == before
    assert sum(f.num_rows for f in files) == 1000
    assert max(f.num_row_groups for f in files) <= 3 and max(f.row_group(g).num_rows for f in files for g in range(f.num_row_groups)) <= 10
    tables.write_partitioned(df, path, ["part"], rows_per_file=7, rows_per_group=10, mode="overwrite")
    assert max(pq.ParquetFile(p).metadata.num_rows for p in (tmp_path / "groups").rglob("*.parquet")) <= 7
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1000))
