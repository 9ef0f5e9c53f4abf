import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ranklake.operators.summary import RunCounts
from ranklake.operators.work import advance, map_work
from ranklake.plans import ladder, match_ids, matches, players, registry
from ranklake.schemas import (
    ENTRY,
    LADDER,
    LADDER_STORED,
    LADDER_PAGES,
    MATCH_IDS,
    MATCH_REPLIES,
    MATCH_STATE,
    MATCHES,
    PLAYER_STATE,
    platforms,
)
from ranklake.session import scratch_path
from ranklake.sinks.tables import conform, newest_state, state_runs
from ranklake.sources.parquet import scan_table

AT, NEXT = "2024-01-05T00:00:00", "2024-01-06T00:00:00"


def entry(puuid, **more):
    values = {"puuid": puuid, "leaguePoints": 1, **more}
    return tuple(values.get(name) for name in ENTRY.names)


@pytest.fixture(scope="module")
def lake(spark):
    """All jobs run once over a small landing area."""
    base = scratch_path(spark, "lake")
    pages = spark.createDataFrame(
        [
            ("kr", "gold", "I", 1, 200, None, [entry("p1"), entry("p2")]),
            ("kr", "gold", "I", 2, 200, None, []),
            ("kr", "gold", "I", 3, 200, None, [entry("never")]),
            ("vn2", "iron", "IV", 1, 200, None, [entry("p1", hotStreak=True), entry("")]),
            ("vn2", "iron", "IV", 2, 429, "4", None),
        ],
        LADDER_PAGES,
    )
    apex = spark.createDataFrame(
        [
            ("kr", "master", None, 1, 200, None, [entry("p3")]),
            ("vn2", "master", None, 1, 404, None, None),
            ("euw1", "master", None, 1, 200, None, None),
        ],
        LADDER_PAGES,
    )
    outcomes = ladder.collect_ladder(pages, apex, platforms(spark), f"{base}/league", AT)
    players.run_players(spark, f"{base}/league", f"{base}/players", "2024-01-05a")
    return base, outcomes


def test_ladder_job(spark, lake, rows):
    base, outcomes = lake
    stored = scan_table(spark, f"{base}/league", LADDER)
    assert rows(stored, "puuid", "tier", "division", "region", "platform", "hot_streak") == [
        ("p1", "GOLD", "I", "asia", "kr", False),
        ("p2", "GOLD", "I", "asia", "kr", False),
        ("p3", "MASTER", "all", "asia", "kr", False),
    ]
    assert rows(outcomes.where("outcome <> 'ok'")) == sorted(
        [("vn2", "iron", "IV", "rate_limited", 4.0), ("vn2", "master", None, "not_found", None)], key=repr
    )


def test_player_job_keeps_read_dates_and_drops_departed(spark, lake, rows):
    base, _ = lake
    first = newest_state(spark, f"{base}/players", PLAYER_STATE)
    assert rows(first, "puuid", "last_read", "platform") == [
        ("p1", None, "kr"), ("p2", None, "kr"), ("p3", None, "kr"),
    ]
    root = scratch_path(spark, "players")
    old = spark.createDataFrame(
        [("p1", date(2024, 1, 1), "r", "p", 0), ("gone", None, "r", "p", 1)], PLAYER_STATE
    )
    old.write.partitionBy("shard_id").parquet(f"{root}/run=1")
    counts = players.run_players(spark, f"{base}/league", root, "2")
    assert sum(r["rows"] for r in counts.collect()) == 3 and counts.count() == 4
    assert rows(newest_state(spark, root, PLAYER_STATE), "puuid", "last_read") == sorted(
        [("p1", date(2024, 1, 1)), ("p2", None), ("p3", None)], key=repr
    )


def id_list(spark, items):
    return spark.createDataFrame(
        [(p, i, m, 420, t) for p, listed in items.items() for i, (m, t) in enumerate(listed)],
        "puuid string, pos long, match_id string, queue int, game_start_timestamp long",
    )


def test_match_jobs_from_ids_to_details(spark, lake, rows):
    base, _ = lake
    day = 86_400_000
    late = 19_728 * day  # 2024-01-06
    state, table = f"{base}/players", f"{base}/matchID"
    ok = spark.createDataFrame(
        [("p1", "ok", None), ("p2", "rate_limited", 9.0), ("p3", "not_found", None)],
        "puuid string, outcome string, retry_after_seconds double",
    )

    # First day: two players are read to the end, one is rate-limited.
    ids = id_list(spark, {"p1": [("m2", 5), ("m1", 4)], "p2": [("m2", 5)]})
    counts = RunCounts()
    plan = match_ids.run_ids(spark, state, ids, ok, table, "2024-01-05b", "2024-01-05", AT, counts=counts)
    spark.sparkContext.setJobGroup("totals", "counts are there without a job")
    assert counts.totals() == {"outcomes": {"rows": 3, "done": 2}, "new": {"rows": 2}, "state": {"rows": 3, "due": 1}}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("totals")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tuple(plan.first()) == ("RATE_LIMITED", 2, 1, 11.0)
    stored = scan_table(spark, table, match_ids.STORED)
    assert rows(stored, "match_id", "puuid", "is_ingested", "region", "platform") == [
        ("m1", "p1", 0, "asia", "kr"), ("m2", "p1", 0, "asia", "kr"),
    ]
    now = newest_state(spark, state, PLAYER_STATE)
    today = date(2024, 1, 5)
    assert rows(now, "puuid", "last_read") == sorted([("p1", today), ("p2", None), ("p3", today)], key=repr)
    assert rows(match_ids.left_over(now, ok, "2024-01-05"), "puuid") == [("p2",)]

    # Same day again: the finished players are skipped, the other one is read now.
    ok = spark.createDataFrame([(p, "ok", None) for p in ("p1", "p2", "p3")], ok.schema)
    match_ids.run_ids(spark, state, ids, ok, table, "2024-01-05c", "2024-01-05", "2024-01-05T09:00:00")
    assert stored_pairs(spark, table) == [("m1", "p1"), ("m2", "p1"), ("m2", "p2")]

    # Next day: only what is new since then, up to the first known id.
    ids = id_list(spark, {"p1": [("m3", late), ("m2", late), ("m9", late)]})
    match_ids.run_ids(spark, state, ids, ok, table, "2024-01-06", "2024-01-06", NEXT)
    want = [("m1", "p1"), ("m2", "p1"), ("m2", "p2"), ("m3", "p1")]
    assert stored_pairs(spark, table) == want
    # The same run repeated adds nothing and leaves the same state.
    before = rows(newest_state(spark, state, PLAYER_STATE))
    match_ids.run_ids(spark, state, ids, ok, table, "2024-01-06", "2024-01-06", NEXT)
    assert stored_pairs(spark, table) == want
    assert rows(newest_state(spark, state, PLAYER_STATE)) == before

    # Match details: one found, one missing, one rate-limited.
    root, details = f"{base}/match-state", f"{base}/match"
    counts = matches.run_plan_matches(spark, table, root, "1")
    assert sum(r["rows"] for r in counts.collect()) == 4
    body = json.dumps({"info": {"gameStartTimestamp": 1700000000000, "gameVersion": "v"}})
    replies = spark.createDataFrame(
        [("m1", 404, None, None), ("m2", 200, None, body), ("m3", 429, "2", None), ("other", 200, None, body)],
        "match_id string, status int, retry_after string, body string",
    )
    counts = RunCounts()
    plan = matches.run_matches(spark, root, replies, details, table, "2", AT, counts=counts)
    assert rows(counts.summary(spark)) == [
        ("new", "rows", 1), ("state", "finished", 3), ("state", "rows", 4),
        ("work", "done", 2), ("work", "ok", 1), ("work", "rows", 3),
    ]
    assert tuple(plan.first()) == ("RATE_LIMITED", 2, 1, 4.0)
    schema = StructType([*MATCHES.fields])
    for name in ("year", "month", "date"):
        schema = schema.add(name, "integer")
    assert rows(scan_table(spark, details, schema), "match_id", "region", "game_version", "year", "month", "date") == [
        ("m2", "asia", "v", 2023, 11, 14)
    ]
    flags = [("m1", "p1", 1), ("m2", "p1", 1), ("m2", "p2", 1), ("m3", "p1", 0)]
    assert rows(scan_table(spark, table, match_ids.STORED), "match_id", "puuid", "is_ingested") == flags
    assert rows(newest_state(spark, root, MATCH_STATE), "match_id", "puuid", "is_ingested") == flags

    # A second run has only the rate-limited match left, and a broken reply does not finish it.
    assert rows(matches.match_work(newest_state(spark, root, MATCH_STATE)), "match_id") == [("m3",)]
    broken = replies.withColumn("status", F.lit(200)).withColumn("body", F.lit("{broken"))
    assert matches.run_matches(spark, root, broken, details, table, "3", AT).first()["remaining"] == 1
    assert scan_table(spark, details, schema).count() == 1
    assert len(state_runs(spark, root)) == 3


def test_match_job_with_last_scope_flags_one_source(spark, rows):
    base = scratch_path(spark, "last")
    table, root = f"{base}/matchID", f"{base}/state"
    day = date(2024, 1, 5)
    listed = spark.createDataFrame(
        [("m1", "p1", 0, "r", "k", None, 0, day), ("m1", "p2", 0, "r", "k", None, 1, day)], match_ids.STORED
    )
    listed.write.partitionBy(*match_ids.FOLDERS).parquet(table)
    matches.run_plan_matches(spark, table, root, "1")
    replies = spark.createDataFrame([("m1", 404, None, None)], MATCH_REPLIES)
    matches.run_matches(spark, root, replies, f"{base}/match", table, "2", AT, scope="last")
    flags = rows(scan_table(spark, table, match_ids.STORED), "puuid", "is_ingested")
    assert flags == [("p1", 0), ("p2", 1)]


def test_odd_bodies_finish_and_unanswered_items_stay(spark, rows):
    work = spark.createDataFrame([(m, "r", "k") for m in "abcdefgh"], "match_id string, region string, platform string")
    deep = '{"info": {"teams": ' + "[" * 900 + "]" * 900 + "}}"
    bodies = {"a": '{"info": {"queueId": 1, "queueId": 2}}', "b": deep, "c": '{"info": {"gameVersion": "' + "x" * 21_000_000 + '"}}'}
    bodies |= {"d": "{broken", "e": None, "f": '{"info": {"queueId": "many"}}'}
    replies = spark.createDataFrame([(m, 200, None, b) for m, b in bodies.items()] + [("g", 429, "2", None)], MATCH_REPLIES)
    judged = matches.judge_replies(work, replies)
    assert rows(judged, "match_id", "outcome") == [
        ("a", "ok"), ("b", "ok"), ("c", "ok"), ("d", "error"), ("e", "error"), ("f", "ok"),
        ("g", "rate_limited"), ("h", "pending"),
    ]
    found = matches.match_rows(judged, AT)
    assert [r[0] for r in rows(found, "match_id", F.length("game_version"))] == ["a", "b", "c", "f"]
    assert matches.resume_plan(judged).first()["remaining"] == 4


def test_half_written_ids_are_completed(spark, lake, rows):
    base = scratch_path(spark, "half")
    state = spark.createDataFrame([("p1", date(2024, 1, 1), "asia", "kr", 0)], PLAYER_STATE)
    state.write.partitionBy("shard_id").parquet(f"{base}/players/run=1")
    late = 19_728 * 86_400_000
    ids = id_list(spark, {"p1": [(f"m{i}", late) for i in range(5)]})
    ok = spark.createDataFrame([("p1", "ok", None)], "puuid string, outcome string, retry_after_seconds double")
    match_ids.run_ids(spark, f"{base}/players", ids, ok, f"{base}/whole", "2", "2024-01-06", NEXT)
    whole = scan_table(spark, f"{base}/whole", match_ids.STORED)
    assert whole.count() == 5
    whole.where("match_id = 'm1'").write.partitionBy(*match_ids.FOLDERS).parquet(f"{base}/half")
    match_ids.run_ids(spark, f"{base}/players", ids, ok, f"{base}/half", "2", "2024-01-06", NEXT)
    assert stored_pairs(spark, f"{base}/half") == [(f"m{i}", "p1") for i in range(5)]


def test_id_pages_to_lists_and_outcomes(spark, rows):
    pages = spark.createDataFrame(
        [
            ("p1", 420, 0, ["m3", "m2"], 200, None), ("p1", 420, 2, ["m1"], 200, None), ("p1", 420, 3, [], 200, None),
            ("p1", 420, 4, None, 503, None), ("p2", 420, 0, ["m9"], 200, None), ("p2", 420, 1, None, 429, "3"),
        ],
        "puuid string, queue int, start long, ids array<string>, status int, retry_after string",
    )
    assert rows(match_ids.listed_ids(pages), "puuid", "pos", "match_id") == [
        ("p1", 0, "m3"), ("p1", 1, "m2"), ("p1", 2, "m1"), ("p2", 0, "m9"),
    ]
    assert rows(match_ids.page_outcomes(pages)) == [("p1", "ok", None), ("p2", "rate_limited", 3.0)]


def test_a_second_day_leaves_the_files_of_the_first(spark, lake, rows):
    base = scratch_path(spark, "days")
    pages = spark.createDataFrame([("kr", "gold", "I", 1, 200, None, [entry("p1")])], LADDER_PAGES)
    none = spark.createDataFrame([], LADDER_PAGES)
    names = lambda: {r[0] for r in scan_table(spark, base, LADDER_STORED).select("_metadata.file_path").collect()}
    ladder.collect_ladder(pages, none, platforms(spark), base, AT)
    first = names()
    ladder.collect_ladder(pages, none, platforms(spark), base, NEXT)
    assert first < names()
    assert scan_table(spark, base, LADDER_STORED).count() == 2


def test_an_item_that_is_empty_now_loses_its_rows(spark, rows, monkeypatch):
    base = scratch_path(spark, "withdrawn")
    none = spark.createDataFrame([], LADDER_PAGES)

    def collect(entries, at, status=200):
        pages = [("kr", "gold", "I", 1, status, None, entries), ("kr", "gold", "II", 1, 200, None, [entry("p9")])]
        ladder.collect_ladder(spark.createDataFrame(pages, LADDER_PAGES), none, platforms(spark), base, at)

    def stored(reader):
        return rows(reader, "puuid", "_ingested_at")

    plain = lambda: scan_table(spark, base, LADDER_STORED)
    read = lambda: ladder.read_ladder(spark, base)
    day, later = datetime(2024, 1, 5), datetime(2024, 1, 6)
    collect([entry("p1"), entry("p2")], AT)
    collect([entry("p1")], NEXT)
    with monkeypatch.context() as m:  # dies between the record and the deletion
        m.setattr(ladder, "clear_emptied", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            collect([], AT)
    left = [("p1", later), ("p9", day), ("p9", later)]
    assert stored(read()) == left and len(stored(plain())) == 5
    collect(None, AT, 503)  # an item that failed keeps what is recorded
    assert stored(read()) == left == stored(plain())
    collect([entry("p3")], AT)  # of the same stamp as the record that it was empty
    assert stored(read()) == stored(plain()) == sorted([*left, ("p3", day)])
    collect(None, AT, 404)
    assert stored(read()) == stored(plain()) == left


def test_work_items_fill_the_tasks(spark):
    work = spark.range(5000).select(F.col("id").alias("n"))
    path = scratch_path(spark, "spread")
    map_work(work, lambda item: (200, None, []), RECORD, ["n"], path=path)
    tasks = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored_pairs(spark, table):
    stored = scan_table(spark, table, match_ids.STORED).select("match_id", "puuid")
    return sorted(tuple(r) for r in stored.collect())


def test_sync_registers_once(spark, lake, rows):
    base, _ = lake
    known = [("league_sync", f"{base}/league", LADDER_STORED, ladder.FOLDERS)]
    first = registry.sync(spark, f"{base}/ledger", known, AT).first()
    second = registry.sync(spark, f"{base}/ledger", known, AT).first()
    assert first["registered"] > 0 and first["snapshot_id"] == 1
    assert (second["registered"], second["snapshot_id"]) == (0, 1)
    assert spark.table("league_sync").count() == 3


def test_lake_tables_sync_before_all_folders_exist(spark, lake, rows):
    base, _ = lake
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    done = registry.sync(spark, f"{base}/lake-ledger", registry.lake_tables(base, "lake"), AT)
    assert {r["table_name"] for r in done.collect()} == {"lake.league", "lake.match_id", "lake.match"}
    assert spark.table("lake.league").count() == 3
    for name in ("league", "match_id", "match"):
        spark.sql(f"DROP TABLE lake.{name}")


def test_conform_rejects_a_missing_column(spark):
    with pytest.raises(Exception):
        conform(spark.createDataFrame([("a",)], "match_id string"), MATCH_IDS).collect()


RECORD = StructType().add("v", LongType())


def test_map_work_outcomes_and_attempts(spark, rows):
    work = spark.createDataFrame([(i,) for i in range(8)], "n long")

    def call(item):
        n = item["n"]
        if n == 6:
            raise RuntimeError("bad item")
        if n == 7:
            raise ConnectionError("no route")
        status = {1: 404, 2: 500, 3: 403}.get(n, 200)
        return status, None, [{"v": n * 10}] * (2 if n == 5 else 1)

    records, outcomes = map_work(work, call, RECORD, ["n"])
    assert rows(records) == [(0, 0), (4, 40), (5, 50), (5, 50)]
    assert rows(outcomes, "n", "outcome", "attempts") == [
        (0, "ok", 1), (1, "not_found", 1), (2, "transient", 5), (3, "error", 1),
        (4, "ok", 1), (5, "ok", 1), (6, "error", 1), (7, "transient", 5),
    ]


def test_a_rate_limited_part_leaves_the_rest_pending(spark):
    work = spark.range(10).select(F.col("id").alias("n"))

    def call(item):
        return (429, "3", []) if item["n"] == 4 else (200, None, [{"v": item["n"]}])

    records, outcomes = map_work(work, call, RECORD, ["n"], parts=1)
    counts = {r[0]: r[1] for r in outcomes.groupBy("outcome").count().collect()}
    assert counts["rate_limited"] == 1 and sum(counts.values()) == 10
    assert records.count() == counts.get("ok", 0)
    limited = outcomes.where("outcome = 'rate_limited'").first()
    assert limited["retry_after_seconds"] == 3.0
    assert outcomes.where("outcome = 'pending' AND attempts > 0").isEmpty()


def test_advance_moves_done_items_only(spark, rows):
    state = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], "k string, is_ingested int")
    outcomes = spark.createDataFrame([("a", "ok"), ("b", "pending"), ("c", "not_found")], "k string, outcome string")
    assert rows(advance(state, outcomes, "k", {"is_ingested": 1})) == [("a", 1), ("b", 0), ("c", 1)]
