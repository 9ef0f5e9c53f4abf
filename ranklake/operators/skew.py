"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklake.session import settle

_SLOTS, _PER_SLOT, _TRACKED = 64, 32, 256


def hot_keys(df: DataFrame, on: list[str], parts: int | None = None) -> DataFrame:
    """Hashes of the keys that overfill a shuffle partition, and the pieces to cut each into.

    One pass over the key columns, with one frequent-item sketch of fixed size per slot of the
    hash: the sketches of all input splits are merged in 64 tasks, not in one. A key with a third
    of the rows gets a third of the partitions. At most 64 x 32 rows come out, so the result may
    be broadcast. The sketch only decides how rows are spread; both sides of a join must see the
    same list, so it is written down before it is used.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (
        df.select(F.xxhash64(*on).alias("_key_hash"))
        .groupBy(F.pmod("_key_hash", F.lit(_SLOTS)).alias("_slot"))
        .agg(
            F.count("*").alias("_in_slot"),
            F.expr(f"approx_top_k(_key_hash, {_PER_SLOT}, {_TRACKED})").alias("_top"),
        )
    )
    rows = F.sum("_in_slot").over(Window.partitionBy(F.lit(0)))  # over the 64 slot rows
    return (
        slots.select(rows.alias("_rows"), "_top")
        .select("_rows", F.inline("_top"))
        .select(
            F.col("item").alias("_key_hash"),
            F.ceil(F.col("count") * parts / F.col("_rows")).cast("int").alias("_pieces"),
        )
        .where("_pieces > 1")
    )


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str],
    hot: DataFrame | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Equi-join with a ``right`` that has each key once, cutting hot keys of ``left`` into pieces.

    ``spread`` names columns of ``left`` that differ between the rows of one key; their hash
    picks the piece, so a repeated task picks the same one. Rows of ``right`` with a hot key
    are repeated once per piece: at most one extra row per shuffle partition in all.

    With ``dedup``, ``right`` may repeat its rows; they are made distinct in the shuffle of the join.
    Give ``hot`` (``hot_keys`` of the scan that ``left`` starts from, same key types, settled) where
    ``left`` is itself the result of joins, which would else run again for the sketch.
    """
    hot = F.broadcast(settle(hot_keys(left, on), "hot-keys") if hot is None else hot)
    for name in on:
        right = right.withColumn(name, F.col(name).cast(left.schema[name].dataType))
    extra = [c for c in right.columns if c not in on]
    piece = F.coalesce(F.pmod(F.xxhash64(F.lit("piece"), *spread), F.col("_pieces")), F.lit(0)).cast("int")
    cut = left.withColumn("_key_hash", F.xxhash64(*on)).join(hot, "_key_hash", "left").withColumn("_piece", piece)
    pieces = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    repeated = (
        right.withColumn("_key_hash", F.xxhash64(*on))
        .join(hot, "_key_hash", "left")
        .withColumn("_piece", F.explode(pieces))
        .select(*on, "_piece", *extra)
    )
    if dedup:
        repeated = repeated.distinct()
    joined = cut.select(*left.columns, "_piece").join(repeated, [*on, "_piece"], how)
    kept = left.columns if how in ("left_semi", "left_anti") else [*left.columns, *extra]
    return joined.select(*kept)
