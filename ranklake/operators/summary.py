"""Counts and run totals."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.operators.normalize import is_done
from ranklake.schemas import RETRY_DEFAULT_SECONDS, RETRY_MARGIN_SECONDS, SHARDS


def shard_counts(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows per shard, with 0 for a shard that has none."""
    every = df.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard_id"))
    found = df.groupBy("shard_id").agg(F.count("*").alias("rows"))
    return every.join(found, "shard_id", "left").select("shard_id", F.coalesce("rows", F.lit(0)).alias("rows"))


def partition_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def ids_by_source(df: DataFrame, source: str = "source_file_path", item: str = "match_id") -> DataFrame:
    """The distinct ids of each source, as rows, so that a source of any size stays spread over tasks."""
    return df.select(source, item).distinct()


def source_counts(df: DataFrame, source: str = "source_file_path", item: str = "match_id") -> DataFrame:
    """Distinct ids per source."""
    return ids_by_source(df, source, item).groupBy(source).agg(F.count("*").alias("ids"))


def run_summary(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per named stage of a run, zeros included."""
    out = None
    for name, df in stages.items():
        counted = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = counted if out is None else out.unionByName(counted)
    return out


class RunCounts:
    """Rows of a job's stages, counted while the job writes them: no scan, and no Spark job, of their own.

    A stage is watched on top of what is written, after the last shuffle, where the rows of a task that ran twice count once.
    """

    _ROWS = StructType().add("stage", "string").add("name", "string").add("rows", "long")

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def at(self, stage: str, **more: Column) -> Callable[[DataFrame], DataFrame]:
        """A step that counts the rows of a frame, and what else is asked of them, when they are written."""

        def watch(df: DataFrame) -> DataFrame:
            self._seen[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
            return df.observe(self._seen[stage], F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in more.items()))

        return watch

    def totals(self) -> dict[str, dict[str, int]]:
        """Counts by stage, once the job has returned."""
        return {stage: dict(seen.get) for stage, seen in self._seen.items()}

    def summary(self, spark: SparkSession) -> DataFrame:
        """``stage, name, rows``, zeros included."""
        found = [(stage, name, n) for stage, counts in self.totals().items() for name, n in counts.items()]
        return spark.createDataFrame(found, self._ROWS)


def resume_plan(outcomes: DataFrame) -> DataFrame:
    """One row: was the run rate-limited, how many items are left, and how long to wait."""
    limited = F.count_if(F.col("outcome") == "rate_limited") > 0
    wait = F.coalesce(F.max("retry_after_seconds"), F.lit(float(RETRY_DEFAULT_SECONDS))) + RETRY_MARGIN_SECONDS
    return outcomes.agg(
        F.when(limited, "RATE_LIMITED").otherwise("COMPLETED").alias("result"),
        F.count_if(is_done()).alias("done"),
        F.count_if(~is_done()).alias("remaining"),
        F.when(limited, wait).alias("delay_seconds"),
    )


def check_retry_after(seconds: float) -> float:
    """A given wait plus the margin; a negative wait is an error."""
    if seconds < 0:
        raise ValueError(f"retry_after must not be negative, got {seconds}")
    return seconds + RETRY_MARGIN_SECONDS
