import pytest
from pyspark.sql import functions as F

from ranklake import session
from ranklake.plans import ladder, match_ids, matches, suspend
from ranklake.schemas import PLAYER_STATE, platforms
from ranklake.sinks import resume, staging

OUTCOMES = "item string, outcome string, retry_after_seconds double"


def put(spark, root, outcomes, output=None):
    work = spark.createDataFrame([(f"i{n}",) for n in range(7)], "item string")
    plan = suspend.put_aside(work, outcomes, output, root, "b", "j1", "2024-01-01", "item", ["item"], parts=2)
    return work, tuple(plan.first())


def test_put_aside_and_take_up(spark, rows):
    root = session.scratch_path(spark, "suspend")
    outcomes = spark.createDataFrame(
        [("i0", "ok", None), ("i1", "not_found", None), ("i2", "rate_limited", 5.0)]
        + [(f"i{n}", "pending", None) for n in range(3, 7)],
        OUTCOMES,
    )
    output = spark.createDataFrame([("i0",)], "item string")
    work, plan = put(spark, root, outcomes, output)
    assert plan == ("RATE_LIMITED", 2, 5, 7.0)
    saved = resume.load_resume(spark, f"{root}/resume", "b", "j1")
    assert rows(saved, "part", "item") == [(0, "i2"), (0, "i3"), (0, "i4"), (1, "i5"), (1, "i6")]
    assert saved.select("retry_after_seconds").distinct().collect()[0][0] == 5.0
    rest = suspend.take_up(work, root, "b", "j1", "item")
    assert rows(rest) == [(f"i{n}",) for n in range(2, 7)]
    assert rows(suspend.with_earlier_output(rest, root, "b", "j1")) == [("i0",)] + [(f"i{n}",) for n in range(2, 7)]
    suspend.finish(spark, root, "b", "j1")
    assert not resume.has_resume(spark, f"{root}/resume", "b", "j1")
    assert not staging.has_stage(spark, f"{root}/staging", "b", "j1")
    assert rows(suspend.take_up(work, root, "b", "j1", "item")) == [(f"i{n}",) for n in range(7)]


def test_a_complete_run_saves_nothing(spark):
    root = session.scratch_path(spark, "complete")
    outcomes = spark.createDataFrame([(f"i{n}", "ok", None) for n in range(7)], OUTCOMES)
    assert put(spark, root, outcomes)[1] == ("COMPLETED", 7, 0, None)
    assert not resume.has_resume(spark, f"{root}/resume", "b", "j1")


def test_ladder_work_left_over_includes_tiers_without_division(spark, rows):
    outcomes = spark.createDataFrame(
        [("kr", "master", None, "ok"), ("kr", "gold", "I", "ok"), ("kr", "gold", "II", "rate_limited")],
        "platform string, tier string, division string, outcome string",
    )
    left = ladder.ladder_work(platforms(spark), outcomes)
    assert left.count() == 122
    names = {r["item"] for r in left.collect()}
    assert "kr/master/all" not in names and {"vn2/master/all", "kr/gold/II"} <= names


def test_fetch_ids_and_replies(spark, rows):
    state = spark.createDataFrame([("p1", None, "r", "k", 0), ("p2", None, "r", "k", 0)], PLAYER_STATE)

    def listed(player):
        if player["puuid"] == "p2":
            return 404, None, []
        return 200, None, [{"pos": 0, "match_id": "m1", "queue": 420, "game_start_timestamp": 5}]

    ids, outcomes = match_ids.fetch_ids(state, listed, "2024-01-05")
    assert rows(ids) == [("p1", 0, "m1", 420, 5)]
    assert rows(outcomes, "puuid", "outcome") == [("p1", "ok"), ("p2", "not_found")]

    work = spark.createDataFrame([("m1", "r", "k"), ("m2", "r", "k"), ("m3", "r", "k")], "match_id string, region string, platform string")

    def reply(item):
        if item["match_id"] == "m3":
            raise ValueError("broken")
        return (200, None, [{"body": "{}"}]) if item["match_id"] == "m1" else (404, None, [])

    judged = matches.judge_replies(work, matches.fetch_replies(work, reply))
    assert rows(judged, "match_id", "outcome") == [("m1", "ok"), ("m2", "not_found"), ("m3", "error")]


def test_one_reply_per_match_counts(spark, rows):
    work = spark.createDataFrame([("m1", "r", "k")], "match_id string, region string, platform string")
    replies = spark.createDataFrame(
        [("m1", 429, "3", None), ("m1", 200, None, "{}"), ("m1", 200, None, "{}"), ("m1", None, None, None)],
        "match_id string, status int, retry_after string, body string",
    )
    assert rows(matches.judge_replies(work, replies), "match_id", "outcome") == [("m1", "ok")]


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_touched_partitions_prune_the_second_pass(spark):
    from ranklake.operators import propagate
    from ranklake.sinks.tables import write_partitioned

    path = session.scratch_path(spark, "prune")
    df = spark.range(1000).select(F.col("id").cast("string").alias("match_id"), F.lit(0).alias("is_ingested"), (F.col("id") % 10).cast("int").alias("shard_id"))
    write_partitioned(df, path, ["shard_id"])
    done = spark.createDataFrame([("13",), ("23",)], "match_id string")
    flagged = propagate.flag_touched(spark.read.parquet(path), done, "match_id", ["shard_id"], ["is_ingested"])
    assert flagged.count() == 100 and flagged.where("is_ingested = 1").count() == 2
    assert "dynamicpruning" in flagged._jdf.queryExecution().toString().lower()


def test_last_scope_with_partly_flagged_folders(spark, rows):
    from ranklake.operators import propagate

    listings = spark.createDataFrame(
        [("m", "a", 1, 1, 0), ("n", "a", 2, 1, 0), ("m", "b", 1, 2, 1)],
        "match_id string, source string, line int, shard_id int, is_ingested int",
    )
    done = spark.createDataFrame([("m",), ("n",)], "match_id string")
    flagged = propagate.flag_touched(listings, done, "match_id", ["shard_id"], ["line"], "last", ["source", "line"])
    assert rows(flagged, "match_id", "source", "is_ingested") == [("m", "a", 0), ("n", "a", 1)]
