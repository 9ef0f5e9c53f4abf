"""The stable hash that decides which shard a key is stored in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklake.schemas import SHARDS


def stable_hash(col: str | Column) -> Column:
    """First eight bytes of the MD5 of the UTF-8 text, as an unsigned number.

    The value may exceed a signed long, hence ``decimal(20,0)``.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")


def shard_of(col: str | Column, shards: int = SHARDS) -> Column:
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    return (stable_hash(col) % F.lit(shards)).cast("int")


def assign_shard(df: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    return df.withColumn("shard_id", shard_of(key, shards))
