import pytest
from pyspark.sql import functions as F

from ranklake.operators import joins, numbering, propagate
from ranklake.operators.skew import hot_keys, join_unique
from ranklake.operators.summary import shard_counts


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 rows, a third of them with one key."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return spark.range(20_000).select(key.alias("k"), F.col("id").alias("n"))


def test_a_hot_key_is_found_and_cut_in_pieces(spark, hot):
    found = hot_keys(hot, ["k"], parts=30).collect()
    assert len(found) == 1
    assert found[0]["_pieces"] in (10, 11)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_unique_equals_a_plain_join(spark, hot, how):
    right = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        got = join_unique(hot, right, ["k"], how, ["n"])
        want = hot.join(right, "k", how)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_join_unique_keeps_null_keys_and_casts_the_right_side(spark, rows):
    left = spark.createDataFrame([(None, 1), (1, 2)], "k long, n int")
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(join_unique(left, right, ["k"], "left", ["n"])) == sorted([(None, 1, None), (1, 2, "x")], key=repr)


def test_hot_rows_spread_over_pieces(spark, hot):
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        right = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        got = join_unique(hot, right, ["k"], "left", ["n"]).groupBy(F.spark_partition_id()).count()
        largest = max(r[1] for r in got.collect())
        assert largest < 20_000 / 3 / 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookup(spark, rows):
    dim = spark.createDataFrame([("kr", "asia"), ("vn2", "sea")], "id string, region string")
    df = spark.createDataFrame([("kr",), ("xx",)], "platform string")
    lenient = joins.lookup(df, dim, "platform", "region", dim_key="id", strict=False)
    assert rows(lenient) == [("kr", "asia"), ("xx", "")]
    with pytest.raises(Exception, match="unknown platform: xx; known: kr, vn2"):
        joins.lookup(df, dim, "platform", "region", dim_key="id").collect()


def test_state_joins(spark, rows):
    keys = spark.createDataFrame([("a",), ("b",)], "puuid string")
    state = spark.createDataFrame([("b", "2024"), ("c", "2023")], "puuid string, last_read string")
    assert rows(joins.merge_state(keys, state, "puuid")) == sorted([("a", None), ("b", "2024")], key=repr)
    assert rows(joins.departed(keys, state, "puuid")) == [("c", "2023")]
    assert rows(joins.arrived(keys, state, "puuid")) == [("a",)]


def test_mark_and_remaining(spark, rows):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, None), ("b", 3, 0)], "m string, n int, is_ingested int")
    done = spark.createDataFrame([("a",), ("a",)], "m string")
    assert rows(joins.mark(df, done, "m", {"is_ingested": 1}, ["n"])) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 0)]
    outcomes = spark.createDataFrame([("a", "ok"), ("b", "rate_limited"), ("c", "not_found")], "m string, outcome string")
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "m string")
    assert rows(joins.remaining(work, outcomes, ["m"])) == [("b",), ("d",)]


def test_resume_work_falls_back_to_all(spark, rows):
    work = spark.createDataFrame([("a",), ("b",)], "m string")
    assert rows(joins.resume_work(work, work.where("m = 'b'"), ["m"])) == [("b",)]
    assert rows(joins.resume_work(work, work.where("m = 'z'"), ["m"])) == [("a",), ("b",)]


def test_propagate_all_and_last(spark, rows):
    listed = spark.createDataFrame(
        [("m1", "f1", 0), ("m1", "f2", 0), ("m2", "f1", 0), ("m3", "f3", 0)],
        "match_id string, source_file_path string, is_ingested int",
    )
    done = spark.createDataFrame([("m1",)], "match_id string")
    touched = propagate.touched_partitions(listed, done, "match_id", ["source_file_path"], ["source_file_path"])
    assert rows(touched) == [("f1", 1), ("f2", 1)]
    every = propagate.flag_listings(listed, done, "match_id", ["source_file_path"])
    assert rows(every, "match_id", "source_file_path") == rows(listed, "match_id", "source_file_path")
    assert rows(every.where("is_ingested = 1"), "match_id", "source_file_path") == [("m1", "f1"), ("m1", "f2")]
    last = propagate.flag_listings(listed, done, "match_id", ["is_ingested"], "last", ["source_file_path"])
    assert rows(last.where("is_ingested = 1"), "match_id", "source_file_path") == [("m1", "f2")]


@pytest.mark.parametrize("total", [0, 1, 3, 4, 7, 1001])
def test_split_even_matches_the_split_rule(spark, total):
    parts = 4
    df = spark.range(total).select((F.col("id") * F.col("id")).alias("k"))
    got = [r["part"] for r in numbering.split_even(df, parts, ["k"]).orderBy("k").collect()]
    base, extra = divmod(total, parts)
    want = [p for p in range(parts) for _ in range(base + (p < extra))]
    assert got == want


def test_numbered_with_groups_nulls_and_copies(spark):
    data = [("a", 1)] * 50 + [("a", i) for i in range(100)] + [(None, 5), (None, 6), ("b", 1)]
    df = spark.createDataFrame(data, "g string, n int")
    got = numbering.numbered(df, ["n"], ["g"]).collect()
    for group in ("a", "b", None):
        mine = sorted((r["row_no"], r["n"]) for r in got if r["g"] == group)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)


def test_rows_per_file_thresholds():
    from ranklake.schemas import FLUSH_BYTES

    sizes = {name: numbering.rows_per_file(limit) for name, limit in FLUSH_BYTES.items()}
    assert sizes == {"ladder": 41_944, "match_ids": 10_486, "matches": 335_545}


def test_shard_counts_has_zeros(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (3,)], "shard_id int")
    assert rows(shard_counts(df)) == [(0, 0), (1, 2), (2, 0), (3, 1)]
