"""Flags carried back to the listings they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.operators.dedup import latest_by
from ranklake.operators.joins import mark
from ranklake.operators.skew import hot_keys, join_unique
from ranklake.session import settle
from ranklake.sinks.journal import replace_partitions


def touched_partitions(
    listings: DataFrame,
    done: DataFrame,
    key: str,
    by: list[str],
    spread: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Partitions with at least one listing of a done id that is not flagged yet, and how many."""
    hits = join_unique(listings.where(~F.col("is_ingested").eqNullSafe(1)), done.select(key), [key], "left_semi", spread, hot, dedup=True)
    return hits.groupBy(*by).agg(F.count("*").alias("hits")).where("hits > 0")


def last_listings(listings: DataFrame, done: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """The last listing of each done id in ``order``: its key and ``columns``."""
    rows = listings.select(key, *dict.fromkeys(columns))
    return latest_by(rows, [key], order).join(done.select(key).distinct(), key, "left_semi")


def flag_listings(
    listings: DataFrame,
    done: DataFrame,
    key: str,
    spread: list[str],
    scope: str = "all",
    order: list[str] = (),
    hot: DataFrame | None = None,
    last: DataFrame | None = None,
) -> DataFrame:
    """Set ``is_ingested`` to 1 on the listings of done ids.

    Scope ``all`` flags every listing. Scope ``last`` flags an id only in the source
    of its last listing in ``order``, whose first column names the source. Give ``last``
    (``last_listings`` of the whole table) where ``listings`` are only a part of it.
    """
    if scope == "all":
        return mark(listings, done, key, {"is_ingested": 1}, spread, hot)
    if scope != "last" or not order:
        raise ValueError("scope must be 'all', or 'last' with an order")
    source = order[0]
    if last is None:
        last = last_listings(listings, done, key, list(order), list(order))
    chosen = last.select(key, source).withColumn("_last", F.lit(True))
    flagged = join_unique(listings, chosen, [key, source], "left", spread)
    new = F.when(F.col("_last"), F.lit(1)).otherwise(F.col("is_ingested")).cast("int")
    return flagged.withColumn("is_ingested", new).drop("_last")


def flag_touched(
    listings: DataFrame,
    done: DataFrame,
    key: str,
    by: list[str],
    spread: list[str],
    scope: str = "all",
    order: list[str] = (),
) -> DataFrame:
    """All rows, flags set, of the partitions in which a flag changes.

    The first pass reads keys and partition columns only. Its result, one row per partition, is
    written down, so that Spark knows its size when it plans the second pass: it is broadcast if
    small enough, and then prunes the folders that are read. The hot keys serve both passes.
    """
    hot = settle(hot_keys(listings, [key]), "hot-keys")
    last = None
    if scope == "last":
        last = settle(last_listings(listings, done, key, [*order, "is_ingested", *by], list(order)), "last-listings")
        touched = last.where(~F.col("is_ingested").eqNullSafe(1)).groupBy(*by).agg(F.count("*").alias("hits"))
    else:
        touched = touched_partitions(listings, done, key, by, spread, hot)
    touched = settle(touched, "touched")
    affected = listings.join(touched.where("hits > 0").select(*by), by, "left_semi").select(*listings.columns)
    return flag_listings(affected, done, key, spread, scope, order, hot, last)


def propagate(
    listings: DataFrame,
    done: DataFrame,
    path: str,
    key: str,
    by: list[str],
    spread: list[str],
    scope: str = "all",
    order: list[str] = (),
) -> None:
    """Rewrite, in the table at ``path``, the partitions that hold a listing of a done id.

    ``listings`` are the rows of that table (with source columns if ``order`` needs them).
    The new rows are complete beside the table before the first old file is replaced, and replace them through the
    journal: a run that dies on the way loses no listing.
    """
    flagged = flag_touched(listings, done, key, by, spread, scope, order)
    keep = [c for c in flagged.columns if c not in ("source_file_path", "source_row")]
    replace_partitions(flagged.select(*keep), path, by)
