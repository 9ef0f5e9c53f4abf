"""A run that was rate-limited, put aside and taken up again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.operators.joins import remaining, resume_work
from ranklake.operators.numbering import split_even
from ranklake.operators.summary import resume_plan
from ranklake.schemas import RETRY_MARGIN_SECONDS
from ranklake.sinks import resume, staging


def put_aside(
    work: DataFrame,
    outcomes: DataFrame,
    output: DataFrame | None,
    root: str,
    job_type: str,
    job_id: str,
    saved_at,
    item: str,
    key: list[str],
    parts: int = 8,
    shard: int | None = None,
) -> DataFrame:
    """Save what a rate-limited run leaves: its items, split evenly over ``parts``, and its output so far.

    Returns the resume plan, whose delay is for the scheduler that starts the next run; the ledger keeps
    the wait as it was asked for, without the margin. A run that was not rate-limited saves nothing. Repeating
    the call replaces what it saved.
    """
    spark = work.sparkSession
    plan = resume_plan(outcomes).first()
    if plan["result"] == "RATE_LIMITED":
        staged = None
        if output is not None:
            staged = staging.stage(output, f"{root}/staging", job_type, job_id)
        left = split_even(remaining(work, outcomes, key), parts, [item])
        rows = resume.resume_rows(
            left, item, job_type, job_id, F.lit(plan["delay_seconds"] - RETRY_MARGIN_SECONDS), saved_at, staged, shard
        )
        resume.save_resume(rows, f"{root}/resume")
    return spark.createDataFrame([plan], resume_plan(outcomes).schema)


def take_up(work: DataFrame, root: str, job_type: str, parent_id: str, item: str) -> DataFrame:
    """The items that the parent run saved; the whole work list if it saved none."""
    spark = work.sparkSession
    if not resume.has_resume(spark, f"{root}/resume", job_type, parent_id):
        return work
    saved = resume.load_resume(spark, f"{root}/resume", job_type, parent_id)
    as_key = F.col("item").cast(work.schema[item].dataType).alias(item)
    return resume_work(work, saved.select(as_key), [item])


def with_earlier_output(output: DataFrame, root: str, job_type: str, parent_id: str) -> DataFrame:
    """New output together with what the parent run had staged."""
    return staging.with_staged(output, f"{root}/staging", job_type, parent_id)


def finish(spark: SparkSession, root: str, job_type: str, parent_id: str) -> None:
    """Forget the parent run, once the output of its successor is written."""
    staging.drop_stage(spark, f"{root}/staging", job_type, parent_id)
    resume.clear_resume(spark, f"{root}/resume", job_type, parent_id)
