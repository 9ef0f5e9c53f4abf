import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ranklake.plans import match_ids, matches
from ranklake.plans.match_ids import FOLDERS, STORED
from ranklake.schemas import MATCH_REPLIES, MATCH_STATE
from ranklake.session import delete_path, scratch_path
from ranklake.sinks import journal, overlay, statelog
from ranklake.sinks.tables import overwrite_partitions
from ranklake.sources.parquet import scan_table, scan_with_source

EARLY, LATE = "2024-01-04T00:00:00", "2024-01-05T00:00:00"


def listings(spark, pairs, stamp, region="asia"):
    rows = spark.createDataFrame(pairs, "match_id string, puuid string").withColumns(
        {
            "is_ingested": F.lit(0), "region": F.lit(region), "platform": F.lit("kr"),
            "_ingested_at": F.lit(stamp).cast("timestamp"), "shard_id": F.pmod(F.xxhash64("puuid"), F.lit(2)).cast("int"),
            "ingested_on": F.lit(stamp[:10]).cast("date"),
        }
    )
    return rows.select(*[f.name for f in STORED])


def files(table):
    found = {}
    for folder, _, names in os.walk(table.removeprefix("file:")):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


@pytest.fixture
def lake(spark):
    base = scratch_path(spark, "overlay")
    table = f"{base}/matchID"
    for stamp in (EARLY, LATE):
        pairs = [(f"m{i}", f"p{i % 7}-{stamp[9]}") for i in range(40)]
        listings(spark, pairs, stamp).write.mode("append").partitionBy(*FOLDERS).parquet(table)
    return base, table


def done(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "match_id string")


def flagged(df):
    return sorted((r.match_id, r.puuid) for r in df.where("is_ingested = 1").collect())


def test_flags_are_read_with_the_rows_and_folded_later(spark, lake):
    _, table = lake
    before = files(table)
    overlay.write_flags(done(spark, ["m1", "m1", "m2", None]), table, "match_id", date(2024, 1, 5), "a", LATE)
    overlay.write_flags(done(spark, ["m3"]), table, "match_id", "2024-01-06", "b", EARLY)
    # A run that died leaves no mark of success; one that is repeated replaces its own flags.
    overlay.write_flags(done(spark, ["m9"]), table, "match_id", "2024-01-06", "torn", LATE)
    delete_path(spark, f"{overlay.overlay_path(table)}/scope=all/day=2024-01-06/run=torn/_SUCCESS")
    overlay.write_flags(done(spark, ["m8"]), table, "match_id", "2024-01-06", "c", LATE)
    overlay.write_flags(done(spark, []), table, "match_id", "2024-01-06", "c", LATE)
    want = flagged(overlay.read_flagged(spark, table, STORED, "match_id", ["puuid"]))
    assert want == sorted([("m1", "p1-4"), ("m1", "p1-5"), ("m2", "p2-4"), ("m2", "p2-5"), ("m3", "p3-4")])
    assert files(table) == before
    assert overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"]) == 3
    assert flagged(scan_table(spark, table, STORED)) == want
    assert scan_table(spark, table, STORED).count() == 80
    assert overlay.flag_folders(spark, table) == []
    assert overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"]) == 0
    # Partitions in which nothing changes keep their files.
    after = files(table)
    hit = {f for f in before if f in after}
    overlay.write_flags(done(spark, ["m1"]), table, "match_id", "2024-01-07", "d", LATE)
    overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"])
    assert files(table) == after and overlay.flag_folders(spark, table) == []
    assert all(after[f] == before[f] for f in hit)


def test_flags_of_one_file(spark, lake):
    _, table = lake
    rows = scan_with_source(spark, table, STORED, partitioned=True)
    one = rows.where("match_id = 'm4'").orderBy(F.desc("source_file_path")).select("match_id", "source_file_path").limit(1)
    overlay.write_flags(one, table, "match_id", "2024-01-05", "a", EARLY, "last")
    found = flagged(overlay.read_flagged(spark, table, STORED, "match_id", ["puuid"]))
    assert len(found) == 1 and found[0][0] == "m4"
    overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"])
    assert flagged(scan_table(spark, table, STORED)) == found
    with pytest.raises(ValueError):
        overlay.write_flags(one, table, "match_id", "2024-01-05", "a", EARLY, "some")


@pytest.mark.parametrize("moment", ["before commit", "folder deleted", "half written", "flags left"])
def test_a_killed_compaction_loses_nothing(spark, lake, monkeypatch, moment):
    _, table = lake
    overlay.write_flags(done(spark, ["m1", "m2", "m5"]), table, "match_id", "2024-01-05", "a", LATE)
    read = lambda: overlay.read_flagged(spark, table, STORED, "match_id", ["puuid"])
    want, all_rows = flagged(read()), sorted((r.match_id, r.puuid) for r in read().collect())

    def killed(df, path, by, rows_per_file=0):
        if path == table:
            if moment in ("folder deleted", "half written"):
                for at in df.select(*by).distinct().collect():
                    delete_path(spark, "/".join([table, *[f"{c}={at[c]}" for c in by]]))
            if moment == "half written":
                overwrite_partitions(df.where("ingested_on = '2024-01-05'"), path, by)
            raise RuntimeError("killed")
        overwrite_partitions(df, path, by, rows_per_file)
        if moment == "before commit":
            raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        if moment == "flags left":
            patched.setattr(journal, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")) if "/run=" in a[1] else delete_path(*a))
        else:
            patched.setattr(journal, "overwrite_partitions", killed)
        with pytest.raises(RuntimeError):
            overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"])
    # A reader sees every row and flag at once; the next writer ends the replacement.
    assert flagged(read()) == want
    assert sorted((r.match_id, r.puuid) for r in read().collect()) == all_rows
    overlay.compact(spark, table, STORED, "match_id", FOLDERS, ["puuid"])
    assert flagged(scan_table(spark, table, STORED)) == want
    assert sorted((r.match_id, r.puuid) for r in scan_table(spark, table, STORED).collect()) == all_rows
    assert not journal.recover(spark, table)


def test_partition_values_come_back_as_they_are(spark):
    table = scratch_path(spark, "values")
    schema = "v int, name string, n int"
    rows = spark.createDataFrame([(1, "007", 1), (2, "a b/c%20", 2), (3, None, 3), (4, "007", 4)], schema)
    rows.write.partitionBy("name").parquet(table)
    new = spark.createDataFrame([(9, "007", 9), (8, None, 8)], schema)
    journal.prepare(new, table, ["name"])
    read = lambda: sorted((r.v, r.name, r.n) for r in journal.scan_published(spark, table, new.schema).collect())
    assert read() == [(2, "a b/c%20", 2), (8, None, 8), (9, "007", 9)]
    assert journal.recover(spark, table) and not journal.recover(spark, table)
    assert read() == [(2, "a b/c%20", 2), (8, None, 8), (9, "007", 9)]


def replies(spark, rows):
    return spark.createDataFrame(rows, MATCH_REPLIES)


def test_daily_runs_rewrite_no_file_and_read_only_new_listings(spark, lake, monkeypatch):
    base, table = lake
    root, details = f"{base}/state", f"{base}/match"
    matches.run_plan_matches(spark, table, root, "1", log=True)
    before, states = files(table), files(root)
    answered = replies(spark, [("m1", 404, None, None), ("m2", 200, None, "{}"), ("m3", 429, "2", None)])
    for _ in range(2):  # a repeated run replaces what it wrote
        plan = matches.run_matches(spark, root, answered, details, table, "2", LATE, log=True).first()
        assert (plan["result"], plan["done"], plan["remaining"]) == ("RATE_LIMITED", 2, 38)
    assert files(table) == before
    assert {f: t for f, t in files(root).items() if f in states} == states
    want = sorted((m, f"p{m[1]}-{d}") for m in ("m1", "m2") for d in "45")
    assert flagged(matches.read_listings(spark, table)) == want
    assert flagged(matches.read_match_state(spark, root)) == want
    assert scan_table(spark, details, spark.read.parquet(details).schema).count() == 1

    # The next day: a match that is new, one that is finished and listed again.
    listings(spark, [("m1", "late"), ("m77", "late")], "2024-01-06T00:00:00").write.mode("append").partitionBy(*FOLDERS).parquet(table)
    opened = []
    scan = matches.scan_files
    monkeypatch.setattr(matches, "scan_files", lambda s, t, names, schema: (opened.append(names), scan(s, t, names, schema))[1])
    matches.run_plan_matches(spark, table, root, "3", log=True)
    assert opened == [[f for f in opened[0] if "ingested_on=2024-01-06" in f]] and len(opened[0]) in (1, 2)
    state = matches.read_match_state(spark, root)
    assert state.count() == 82 and flagged(state) == want

    # Folded: the same state and listings, and the moved rows are not planned again.
    assert matches.compact_matches(spark, root, table, "4") == 1
    assert flagged(scan_table(spark, table, STORED)) == want
    assert flagged(matches.read_match_state(spark, root)) == want
    assert not [f for f in files(root) if "/delta=" in f or "/done=" in f]
    matches.run_plan_matches(spark, table, root, "5", log=True)
    assert matches.read_match_state(spark, root).count() == 82
    with pytest.raises(ValueError):
        statelog.compact_state(spark, root, MATCH_STATE, "match_id", ["puuid"], "3")


def test_rows_of_a_repeated_append_are_planned(spark, lake):
    base, table = lake
    root = f"{base}/state"
    matches.run_plan_matches(spark, table, root, "1", log=True)
    # An append of the same stamp that had died half-way: its other rows come after the plan.
    listings(spark, [("m500", "p1")], LATE).write.mode("append").partitionBy(*FOLDERS).parquet(table)
    matches.run_plan_matches(spark, table, root, "2", log=True)
    state = matches.read_match_state(spark, root)
    assert state.count() == 81 and state.where("match_id = 'm500'").count() == 1


def test_last_scope_beside_the_table(spark, lake):
    base, table = lake
    root = f"{base}/state"
    matches.run_plan_matches(spark, table, root, "1", log=True)
    matches.run_matches(spark, root, replies(spark, [("m6", 404, None, None)]), f"{base}/match", table, "2", LATE, "last", log=True)
    found = flagged(matches.read_listings(spark, table))
    assert found == [("m6", "p6-5")]
    matches.compact_matches(spark, root, table, "3")
    assert flagged(scan_table(spark, table, STORED)) == found
    assert matches.match_work(matches.read_match_state(spark, root)).count() == 39


def test_propagate_goes_through_the_journal(spark, lake, monkeypatch):
    from ranklake.operators import propagate as op

    _, table = lake
    rows = scan_table(spark, table, STORED)
    monkeypatch.setattr(journal, "recover", lambda *a: False)
    op.propagate(rows, done(spark, ["m1"]), table, "match_id", FOLDERS, ["puuid"])
    monkeypatch.undo()
    assert flagged(scan_table(spark, table, STORED)) == []
    assert journal.recover(spark, table)
    assert flagged(scan_table(spark, table, STORED)) == [("m1", "p1-4"), ("m1", "p1-5")]


def test_match_ids_end_a_replacement_before_they_append(spark, lake, monkeypatch):
    _, table = lake
    called = []
    monkeypatch.setattr(match_ids.journal, "recover", lambda s, t: called.append(t))
    with pytest.raises(Exception):
        match_ids.run_ids(spark, "/nowhere", None, None, table, "1", "2024-01-06", LATE)
    assert called == [table]


def test_a_replacement_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    from ranklake.sinks import tables

    table, calls, dealt = str(tmp_path / "t"), [], tables._grouped
    spark.range(100).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(table)
    monkeypatch.setattr(tables, "_grouped", lambda df, by: calls.append(by) or dealt(df, by))
    rows = spark.read.parquet(table).where("part < 2").selectExpr("id + 1000 AS id", "part")
    journal.replace_partitions(rows, table, ["part"])
    assert calls == [["part"]]
    found = sorted(r.id for r in spark.read.parquet(table).collect())
    assert found == sorted(i if i % 3 == 2 else i + 1000 for i in range(100))
