"""The new part of an ordered list of ids, per key.

Every window here works on rows already cut to ``cap`` per key, so its groups are
bounded; the cut itself is made on the map side first, and before the join with the stored ids. That
loses nothing: what follows the first ``cap`` rows of a key can neither be kept nor end the list earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.functions.dates import midnight_epoch
from ranklake.operators.dedup import cap_per_key
from ranklake.operators.filters import is_due
from ranklake.operators.joins import flag_known
from ranklake.operators.skew import join_unique
from ranklake.schemas import IDS_PER_PLAYER, QUEUE


def _until_first(df: DataFrame, key: str, pos: str, stop: Column) -> DataFrame:
    so_far = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_stopped", F.max(stop.cast("int")).over(so_far)).where("_stopped = 0").drop("_stopped")


def _repeats(key: str, item: str, pos: str) -> Column:
    return F.row_number().over(Window.partitionBy(key, item).orderBy(pos)) > 1


def take_until_seen(
    df: DataFrame, key: str, pos: str, item: str, known: DataFrame, cap: int = IDS_PER_PLAYER
) -> DataFrame:
    """Per key, the rows before the first id that is known or has occurred before, ``cap`` at most.

    ``known`` has columns ``key`` and ``item``. ``pos`` orders the rows of a key without ties.
    """
    first = cap_per_key(df, [key], [pos], cap).withColumn("_again", _repeats(key, item, pos))
    first = flag_known(first, known, [key, item], None, "_known")
    return _until_first(first, key, pos, F.col("_known") | F.col("_again")).select(*df.columns)


def increment(
    ids: DataFrame,
    state: DataFrame,
    known: DataFrame,
    as_of,
    key: str = "puuid",
    pos: str = "pos",
    item: str = "match_id",
    start: str = "game_start_timestamp",
    cap: int = IDS_PER_PLAYER,
    queue: int | str = QUEUE,
    queue_col: str = "queue",
) -> DataFrame:
    """New ids of every key that is due, with the other columns of its state row.

    A key never read takes its first ``cap`` ids, repeats included. A key read before
    ``as_of`` takes the ids since that day, up to the first one already seen. Others take none.
    """
    waiting = state.where(is_due(as_of))
    queued = ids.where(F.col(queue_col) == F.lit(queue))
    listed = join_unique(queued, waiting, [key], "inner", [pos])
    recent = F.col("last_read").isNull() | (F.col(start) >= midnight_epoch("last_read") * 1000)
    first = cap_per_key(listed.where(recent), [key], [pos], cap).withColumn("_again", _repeats(key, item, pos))
    first = flag_known(first, known, [key, item], None, "_known")
    stop = F.col("last_read").isNotNull() & (F.col("_known") | F.col("_again"))
    return _until_first(first, key, pos, stop).drop("_known", "_again")
