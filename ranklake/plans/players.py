"""The ladder table to player state, split into shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.functions.hashing import assign_shard
from ranklake.operators.dedup import dedup_best
from ranklake.operators.filters import valid_key
from ranklake.operators.joins import merge_state
from ranklake.operators.summary import RunCounts, shard_counts
from ranklake.plans.ladder import read_ladder
from ranklake.schemas import DAY, PLAYER_STATE, SHARDS
from ranklake.sinks.tables import conform, newest_state, write_state
from ranklake.sources.parquet import last_shard_wins, scan_table

TIES = ["region", "platform", "division"]


def plan_players(
    ladder: DataFrame,
    state: DataFrame,
    shards: int = SHARDS,
    key: str = "puuid",
    rank: Column | None = None,
    ties: list = TIES,
) -> DataFrame:
    """One row per current player: its best row, its stored read date, and its shard.

    Players that are only in the state have left the ladder and are dropped.
    """
    best = dedup_best(valid_key(ladder, key), key, rank, ties).select(key, "region", "platform")
    return assign_shard(merge_state(best, state, key), key, shards)


def run_players(
    spark: SparkSession,
    ladder_path: str,
    state_root: str,
    run: str,
    shards: int = SHARDS,
    days: list | None = None,
    counts: RunCounts | None = None,
) -> DataFrame:
    """Write the player state of ``run`` and return its rows per shard.

    ``days`` names the days of ingestion to read, all by default; the folders of others are not opened.
    ``counts`` takes the players of the ``state``, and how many of them are ``unread``.
    """
    state = last_shard_wins(newest_state(spark, state_root, PLAYER_STATE, run), "puuid")
    rows = read_ladder(spark, ladder_path)
    planned = plan_players(rows if days is None else rows.where(F.col(DAY).isin(days)), state, shards)
    seen = (counts or RunCounts()).at("state", unread=F.count_if(F.col("last_read").isNull()))
    path = write_state(conform(planned, PLAYER_STATE), state_root, run, seen=seen)
    return shard_counts(scan_table(spark, path, PLAYER_STATE), shards)
