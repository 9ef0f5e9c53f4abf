"""Joins with dimensions, state and finished work. All are equi-joins.

Nothing is broadcast by hint but the bounded list of hot keys. Spark broadcasts a side whose known size
allows it, and small sides are written first so that it is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ranklake.operators.normalize import is_done
from ranklake.operators.skew import join_unique
from ranklake.session import settle

#: Known keys that an error names.
_NAMED = 100


def lookup(
    df: DataFrame, dim: DataFrame, on: str, value: str, dim_key: str | None = None, strict: bool = True
) -> DataFrame:
    """Add ``value`` of the dimension row with the same key.

    An unknown key is an error that names the known ones (the first hundred), or gives ``''`` if not ``strict``.
    Facts often have few distinct keys here, so the join cuts hot keys into pieces; a dimension that
    Spark knows to be small, as it is written first, is broadcast instead of shuffled.
    """
    side = settle(dim.select(F.col(dim_key or on).alias("_dim_key"), F.col(value).alias("_dim_value")), "dimension")
    flat = [f.name for f in df.schema if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    keyed = df.withColumn("_dim_key", F.col(on).cast(side.schema["_dim_key"].dataType))
    marked = side.withColumn("_dim_known", F.lit(True))
    joined = join_unique(keyed, marked, ["_dim_key"], "left", flat)
    if strict:
        # A dimension may be large, so the message names its first keys only; finding them holds so many in a task.
        few = side.select(F.col("_dim_key").cast("string").alias("name")).distinct().orderBy("name").limit(_NAMED)
        text = F.concat(
            F.lit(f"unknown {on}: "), F.coalesce(F.col(on).cast("string"), F.lit("NULL")),
            F.lit("; known: "), F.coalesce(few.agg(F.array_join(F.sort_array(F.collect_list("name")), ", ")).scalar(), F.lit("")),
        )
        found = F.when(F.col("_dim_known").isNull(), F.raise_error(text)).otherwise(F.col("_dim_value"))
    else:
        found = F.coalesce(F.col("_dim_value"), F.lit(""))
    return joined.withColumn(value, found).drop("_dim_key", "_dim_value", "_dim_known")


def merge_state(keys: DataFrame, state: DataFrame, key: str, value: str = "last_read") -> DataFrame:
    """Current keys (one row each) with the value stored for them, or NULL if new."""
    return keys.join(state.select(key, value), key, "left").select(*keys.columns, value)


def departed(keys: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """State rows whose key is no longer current."""
    return state.join(keys.select(key), key, "left_anti")


def arrived(keys: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Current keys that have no state yet."""
    return keys.join(state.select(key), key, "left_anti")


def flag_known(
    df: DataFrame,
    existing: DataFrame,
    on: list[str],
    spread: list[str] | None,
    name: str = "known",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add whether the row's key is among ``existing``.

    ``spread`` names columns that differ between rows of one key; None says that a key has a bounded
    number of rows in ``df``.
    """
    seen = existing.select(*on, F.lit(True).alias(name))
    if spread is None:
        joined = df.join(seen.distinct(), on, "left").select(*df.columns, name)
    else:
        joined = join_unique(df, seen, on, "left", spread, hot, dedup=True)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def mark(
    df: DataFrame,
    done: DataFrame,
    key: str,
    values: dict,
    spread: list[str] | None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Set ``values`` on the rows whose key is in ``done``; leave the others."""
    flagged = flag_known(df, done, [key], spread, "_done", hot)
    new = {
        name: F.when(F.col("_done"), v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(name)).cast(
            df.schema[name].dataType
        )
        for name, v in values.items()
    }
    return flagged.withColumns(new).drop("_done")


def existing_keys(table: DataFrame, wanted: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Distinct stored ``keys`` of the wanted groups only.

    Where ``on`` holds partition columns, only the partitions of the wanted groups are read.
    A group with a large share of the stored keys is cut into pieces.
    """
    stored = table.select(*{**dict.fromkeys(on), **dict.fromkeys(keys)})
    spread = [k for k in keys if k not in on]
    groups = wanted.select(*on)
    if spread:
        return join_unique(stored, groups, on, "left_semi", spread, dedup=True).select(*keys).distinct()
    return stored.distinct().join(groups.distinct(), on, "left_semi").select(*keys)


def new_files(listed: DataFrame, ledger: DataFrame, path: str = "file_path") -> DataFrame:
    """Listed files that the ledger does not hold."""
    return listed.join(ledger.select(path), path, "left_anti")


def remaining(work: DataFrame, outcomes: DataFrame, key: list[str]) -> DataFrame:
    """Work items without a done outcome. NULL in a key counts as a value."""
    done = outcomes.where(is_done()).select(*[F.col(k).alias(f"_done_{k}") for k in key])
    same = [F.col(k).eqNullSafe(F.col(f"_done_{k}")) for k in key]
    return work.join(done, same, "left_anti")


def resume_work(work: DataFrame, saved: DataFrame, key: list[str]) -> DataFrame:
    """The saved remaining items of all parts; the full work list if none was saved."""
    saved = saved.select(*key).distinct()
    any_saved = saved.agg(F.count("*") > 0).scalar()
    flagged = work.join(saved.withColumn("_saved", F.lit(True)), key, "left")
    return flagged.where(F.col("_saved") | ~any_saved).select(*work.columns)
