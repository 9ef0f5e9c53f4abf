"""One key with a third of all rows: results stay whole, and no task holds the key."""

import pytest
from pyspark.sql import functions as F

from ranklake.operators.increment import take_until_seen
from ranklake.operators.joins import mark
from ranklake.operators.numbering import chunk_files
from ranklake.sinks.tables import write_partitioned
from ranklake.session import scratch_path
from ranklake.sources.pages import pages_until_empty

ROWS = 30_000


@pytest.fixture(scope="module")
def ids(spark):
    """One player lists a third of all ids."""
    player = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("string")
    return spark.range(ROWS).select(
        player.alias("puuid"), F.col("id").alias("pos"), F.concat(F.lit("m"), F.col("id") % 9973).alias("match_id")
    )


def test_take_until_seen_on_a_hot_player(spark, ids):
    known = spark.createDataFrame([("0", "m9000"), ("7", "m3007")], "puuid string, match_id string")
    got = {}
    for row in take_until_seen(ids, "puuid", "pos", "match_id", known).collect():
        got.setdefault(row["puuid"], []).append((row["pos"], row["match_id"]))
    old = {(r[0], r[1]) for r in known.collect()}
    want = {}
    closed = set()
    seen = set()
    for row in ids.orderBy("pos").collect():
        player, item = row["puuid"], row["match_id"]
        if player in closed:
            continue
        if (player, item) in old or (player, item) in seen:
            closed.add(player)
            continue
        seen.add((player, item))
        if len(want.setdefault(player, [])) < 1000:
            want[player].append((row["pos"], item))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_mark_on_a_hot_id(spark, ids):
    done = spark.createDataFrame([("0",), ("3",)], "puuid string")
    flagged = mark(ids.withColumn("flag", F.lit(0)), done, "puuid", {"flag": 1}, ["pos"])
    assert flagged.count() == ROWS
    assert flagged.where("flag = 1").count() == ids.where("puuid IN ('0', '3')").count()
    assert flagged.where("flag = 1 AND puuid NOT IN ('0', '3')").isEmpty()


def test_chunks_of_a_hot_partition(spark, ids):
    got = chunk_files(ids, ["puuid"], ["pos"], threshold=100_000).where("puuid = '0'")
    sizes = [r[1] for r in sorted(tuple(r) for r in got.groupBy("file_no").count().collect())]
    total = ids.where("puuid = '0'").count()
    assert sizes == [1000] * (total // 1000) + [total % 1000] * (total % 1000 > 0)


def test_a_hot_partition_is_written_by_many_tasks(spark, ids):
    path = scratch_path(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        wide = ids.withColumn("text", F.sha2("match_id", 512))
        keep = wide.withColumn("group", F.when(F.col("puuid") == "0", 0).otherwise(F.col("pos") % 7).cast("int"))
        write_partitioned(keep, path, ["group"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(path)
    files = stored.where("group = 0").select("_metadata.file_path").distinct().count()
    assert stored.count() == ROWS and files > 1


def test_pages_of_a_hot_key(spark):
    pages = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("page"),
        F.when(F.col("id") != 15_000, F.array(F.col("id"))).alias("entries"),
    )
    got = pages_until_empty(pages, ["k"])
    assert got.where("k = 0").count() == 5_000
    assert got.count() == 5_000 + ROWS - ROWS // 3
