import hashlib
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from ranklake.functions import dates, hashing, layout, text
from ranklake.operators import filters, normalize
from ranklake.operators.summary import check_retry_after, resume_plan
from ranklake.schemas import DIVISIONS, TIERS


def test_hash_matches_md5_definition_even_above_long_range(spark):
    words = ["", "a", "player-1", "Ünïcödé", "日本語"] + [f"id{i}" for i in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", hashing.stable_hash("w"), *[hashing.shard_of("w", n) for n in (1, 4, 7)]).collect()
    seen_large = False
    for word, value, one, four, seven in got:
        want = int.from_bytes(hashlib.md5(word.encode()).digest()[:8], "big")
        seen_large |= want >= 2**63
        assert (int(value), one, four, seven) == (want, 0, want % 4, want % 7)
    assert seen_large


def test_shards_are_balanced(spark):
    df = hashing.assign_shard(spark.range(20_000).select(F.concat(F.lit("p"), "id").alias("k")), "k")
    counts = [r[1] for r in df.groupBy("shard_id").count().collect()]
    assert len(counts) == 4 and max(counts) < 1.1 * min(counts)


def test_shard_count_is_checked():
    with pytest.raises(ValueError):
        hashing.shard_of("w", 0)


def test_tier_rank_covers_case_blank_and_unknown(spark):
    df = spark.createDataFrame([("Challenger",), ("IRON",), ("",), (None,), ("wood",), ("bronze",)], "t string")
    assert [r[0] for r in df.select(text.tier_rank("t")).collect()] == [0, 9, 8, 8, 999, 8]


def test_partition_date_edges(spark):
    cases = [0, 1700000000000, 1704067199999, 1704067200000, 253402300799999]
    df = dates.with_partition_date(spark.createDataFrame([(c,) for c in cases], "ms long"), "ms")
    for ms, year, month, day in df.collect():
        want = datetime.fromtimestamp(ms // 1000, tz=UTC)
        assert (year, month, day) == (want.year, want.month, want.day)


def test_partition_date_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = dates.with_partition_date(spark.createDataFrame([(1704067200000,)], "ms long"), "ms")
        assert tuple(df.first()) == (1704067200000, 2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_negative_start_is_an_error(spark):
    with pytest.raises(Exception, match="negative"):
        dates.with_partition_date(spark.createDataFrame([(-1,)], "ms long"), "ms").collect()


def test_parse_date_forms(spark):
    day = date(2024, 3, 5)
    df = spark.createDataFrame(
        [("2024-03-05", 1709596800 + 5, 19787, 1709596800.0, day), (None, None, None, float("nan"), None)],
        "text string, seconds long, days int, number double, day date",
    )
    got = df.select(
        dates.parse_date("text", "text"),
        dates.parse_date("seconds", "epoch_seconds"),
        dates.parse_date("days", "epoch_days"),
        dates.parse_date("number", "epoch_seconds"),
        dates.parse_date("day", "date"),
        dates.parse_date(F.timestamp_seconds("seconds"), "timestamp"),
    ).collect()
    assert tuple(got[0]) == (day,) * 6
    assert tuple(got[1]) == (None,) * 6


def test_parse_date_rejects_bad_text(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("soon",)], "t string").select(dates.parse_date("t", "text")).collect()


def test_midnight_epoch(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),)], "d date")
    assert df.select(dates.midnight_epoch("d")).first()[0] == 1704067200


def test_layout_paths_and_back(spark):
    df = spark.createDataFrame([("asia", "kr", "GOLD", None, "p1")], "region string, platform string, tier string, division string, puuid string")
    assert df.select(layout.layout_path("league")).first()[0] == "league/asia/kr/gold/all/"
    assert df.select(layout.layout_path("match_id")).first()[0] == "matchID/asia/kr/p1/"
    assert df.select(layout.table_uri("gs://lake", F.lit("/a/b"))).first()[0] == "gs://lake/a/b"
    assert df.select(layout.table_uri("lake", F.lit("a/b"))).first()[0] == "gs://lake/a/b"
    files = spark.createDataFrame([("gs://lake/match/asia/kr/2024/1/31/x.parquet",)], "source_file_path string")
    names = ["region", "platform", "year", "month", "date"]
    assert tuple(layout.with_path_columns(files, names).select(*names).first()) == ("asia", "kr", "2024", "1", "31")


def test_partition_text_pads_month_and_day(spark):
    df = spark.createDataFrame([("asia", "kr", 2024, 1, 5)], "r string, p string, y int, m int, d int")
    assert df.select(layout.partition_text("r", "p", "y", "m", "d")).first()[0] == "asia_kr_2024_01_05"


def test_valid_key_and_pending_and_due(spark, rows):
    keys = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    assert rows(filters.valid_key(keys, "k")) == [("a",)]
    flags = spark.createDataFrame([("a", 0), ("b", 1), ("c", None)], "k string, is_ingested int")
    assert rows(filters.pending(flags), "k") == [("a",)]
    days = [(None,), (date(2024, 1, 1),), (date(2024, 1, 2),), (date(2024, 1, 3),)]
    state = spark.createDataFrame(days, "last_read date")
    assert rows(filters.due(state, "2024-01-02")) == sorted([(date(2024, 1, 1),), (None,)], key=repr)


def test_since_checks_page_size_and_includes_midnight(spark, rows):
    df = spark.createDataFrame(
        [("a", 420, 1704067199999), ("b", 420, 1704067200000), ("c", 400, 1704067200000)],
        "k string, queue int, game_start_timestamp long",
    )
    day = F.lit(date(2024, 1, 1))
    assert rows(filters.since(df, day), "k") == [("b",)]
    assert rows(filters.since(df), "k") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        filters.since(df, page_size=101)


def test_scope(spark, rows):
    df = spark.createDataFrame([("vn2", "diamond", 1), ("vn2", "gold", 1), ("kr", "diamond", 2)], "platform string, tier string, page int")
    assert rows(filters.scope(df, platform="vn2", tier="diamond", page=1)) == [("vn2", "diamond", 1)]
    assert filters.scope(df, platform=None).count() == 3


def test_outcomes(spark):
    cases = [
        (200, None, "ok", None),
        (404, "9", "not_found", None),
        (429, "3", "rate_limited", 3.0),
        (429, "2.5", "rate_limited", 2.5),
        (429, "soon", "rate_limited", None),
        (429, None, "rate_limited", None),
        (500, None, "transient", None),
        (503, None, "transient", None),
        (None, None, "transient", None),
        (403, None, "error", None),
        (501, None, "error", None),
    ]
    df = spark.createDataFrame([(s, h) for s, h, _, _ in cases], "status int, retry_after string")
    got = [tuple(r) for r in normalize.classify(df).collect()]
    assert got == [(s, h, o, w) for s, h, o, w in cases]


def test_resume_plan_delay(spark):
    def plan(items):
        return tuple(resume_plan(spark.createDataFrame(items, "outcome string, retry_after_seconds double")).first())

    assert plan([("ok", None), ("rate_limited", 3.0), ("rate_limited", 7.5)]) == ("RATE_LIMITED", 1, 2, 9.5)
    assert plan([("rate_limited", None), ("pending", None)]) == ("RATE_LIMITED", 0, 2, 122.0)
    assert plan([("ok", None), ("not_found", None)]) == ("COMPLETED", 2, 0, None)
    assert check_retry_after(10) == 12
    with pytest.raises(ValueError):
        check_retry_after(-1)


ENTRY = "struct<puuid: string, summonerId: string, summonerName: string, rank: string, tier: string, queueType: string, leaguePoints: int, wins: int, losses: int, veteran: boolean, inactive: boolean, freshBlood: boolean, hotStreak: boolean>"


def test_entries_defaults_from_json(spark):
    text_rows = [('{"puuid": "p", "leaguePoints": 5, "hotStreak": true}',), ('{"puuid": null}',)]
    df = spark.createDataFrame(text_rows, "j string").select(
        F.from_json("j", ENTRY).alias("entry"),
        F.lit("gold").alias("tier"),
        F.lit(None).cast("string").alias("division"),
        F.lit("asia").alias("region"),
        F.lit("kr").alias("platform"),
    )
    got = normalize.normalize_entries(df, "2024-01-01T00:00:00").drop("_ingested_at").collect()
    assert tuple(got[0]) == ("p", "", "", "GOLD", "all", 5, 0, 0, False, False, False, True, "asia", "kr")
    assert tuple(got[1]) == ("", "", "", "GOLD", "all", 0, 0, 0, False, False, False, False, "asia", "kr")


def test_match_defaults(spark):
    bodies = [
        '{"metadata": {"participants": ["a", "b"]}, "info": {"gameStartTimestamp": 5, "gameDuration": 6, "gameVersion": "v", "queueId": 420, "teams": [{"t": 1}], "participants": [{"x": 2}]}}',
        '{"info": {"gameStartTimestamp": null}}',
        '{"metadata": {}}',
    ]
    df = spark.createDataFrame([(f"m{i}", "r", "p", b) for i, b in enumerate(bodies)], "match_id string, region string, platform string, body string")
    got = [tuple(r)[1:7] for r in normalize.normalize_match(df, "2024-01-01").orderBy("match_id").collect()]
    assert got[0] == (5, 6, "v", 420, '["a","b"]', '[{"t":1}]')
    assert got[1] == got[2] == (0, 0, "", 0, "[]", "[]")
    raw = normalize.normalize_match(df, "2024-01-01", participants_from="info").orderBy("match_id").first()
    assert raw["participants"] == '[{"x":2}]'


def test_work_grid_has_124_items(spark):
    from ranklake.operators.grid import work_grid
    from ranklake.schemas import platforms

    grid = work_grid(platforms(spark))
    assert grid.count() == 124 == 4 * (3 + len(TIERS) * len(DIVISIONS))
    assert grid.where("division IS NULL").count() == 12
