"""Landed pages of a paged source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.text import key_text
from ranklake.operators.normalize import classify, outcome
from ranklake.operators.skew import join_unique


def read_landed(spark: SparkSession, path: str, schema: StructType, tolerant: bool = False) -> DataFrame:
    """Landed JSON, one object per line; no rows if nothing has landed.

    A line that does not fit is an error, or left out if ``tolerant``.
    """
    try:
        mode = "DROPMALFORMED" if tolerant else "FAILFAST"
        return spark.read.schema(schema).option("mode", mode).json(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def pages_before_stop(pages: DataFrame, keys: list[str], page: str, stop: Column) -> DataFrame:
    """Per key, the pages before the first one for which ``stop`` holds."""
    names = {f"_key{i}": key_text(k) for i, k in enumerate(keys)}
    keyed = pages.withColumns(names)
    ends = keyed.where(stop).groupBy(*names).agg(F.min(page).alias("_end"))
    joined = join_unique(keyed, ends, list(names), "left", [page])
    return joined.where(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).select(*pages.columns)


def pages_until_empty(
    pages: DataFrame,
    keys: list[str],
    page: str = "page",
    entries: str = "entries",
    status: str | None = None,
    name: str = "entry",
) -> DataFrame:
    """One row per entry of the pages before the first empty, missing or failed one of each key."""
    stop = F.coalesce(F.size(entries), F.lit(0)) <= 0
    if status is not None:
        stop = stop | (outcome(status) != "ok")
    return explode_entries(pages_before_stop(pages, keys, page, stop), entries, name)


def explode_entries(df: DataFrame, entries: str = "entries", name: str = "entry") -> DataFrame:
    """One row per element of ``entries``; none for an empty or missing list."""
    rest = [c for c in df.columns if c != entries]
    return df.select(*rest, F.explode(entries).alias(name))


def explode_ids(pages: DataFrame, start: str = "start", ids: str = "ids", name: str = "match_id") -> DataFrame:
    """One row per listed id, with its place in the whole list of the key."""
    rest = [c for c in pages.columns if c not in (start, ids)]
    return pages.select(*rest, start, F.posexplode(ids).alias("_i", name)).select(
        *rest, (F.col(start) + F.col("_i")).alias("pos"), name
    )


def key_outcomes(pages: DataFrame, keys: list[str], page: str = "page", entries: str = "entries") -> DataFrame:
    """One outcome per key: that of its first failed page, else ``ok``.

    A page without entries ends the list of its key; what lies behind it is not judged. Pages that do
    not carry their entries are all judged.
    """
    judged = classify(pages)
    failed = F.col("outcome") != "ok"
    first = F.min(F.when(failed, F.struct(F.col(page).alias("page"), "outcome")))
    empty = F.coalesce(F.size(entries), F.lit(0)) <= 0 if entries in pages.columns else F.lit(False)
    last = F.min(F.when(~failed & empty, F.col(page)))
    found = judged.groupBy(*keys).agg(
        first.alias("_first"), last.alias("_last"), F.max("retry_after_seconds").alias("_wait")
    )
    unfinished = F.col("_first").isNotNull() & (F.col("_last").isNull() | (F.col("_first.page") < F.col("_last")))
    return found.select(
        *keys,
        F.when(unfinished, F.col("_first.outcome")).otherwise(F.lit("ok")).alias("outcome"),
        F.when(unfinished, F.col("_wait")).alias("retry_after_seconds"),
    )
