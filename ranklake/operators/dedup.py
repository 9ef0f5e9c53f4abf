"""One row per key.

The ranking window keeps its best rows on the map side before the shuffle
(``WindowGroupLimit``), so a hot key sends one row per input partition. Spark does that for up to
``spark.sql.optimizer.windowGroupLimitThreshold`` rows; for more, a key is first cut in pieces by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ranklake.functions.text import tier_rank


def cap_per_key(df: DataFrame, keys: list[str], order: list, cap: int) -> DataFrame:
    """The first ``cap`` rows of each key."""
    if cap < 1:
        raise ValueError(f"cap must be at least 1, got {cap}")
    if cap > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        flat = [f.name for f in df.schema if isinstance(f.dataType, AtomicType) and f.name not in keys]
        piece = F.pmod(F.xxhash64(F.lit("piece"), *flat), F.lit(parts))
        df = _first(df.withColumn("_piece", piece), [*keys, "_piece"], order, cap).drop("_piece")
    return _first(df, keys, order, cap)


def _first(df: DataFrame, keys: list[str], order: list, cap: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")


def best_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in ``order``."""
    return cap_per_key(df, keys, order, 1)


def dedup_best(df: DataFrame, key: str, rank: Column | None = None, ties: list = ()) -> DataFrame:
    """The row with the best tier of each key; ``ties`` decides between equal tiers."""
    return best_per_key(df, [key], [tier_rank("tier") if rank is None else rank, *ties])


def best_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``best_per_key`` as an aggregate, for an order that has no ties."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"_best.{c}") for c in df.columns])


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    return best_per_key(df, keys, [F.desc(c) for c in order])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()
