"""The ledger of work left over by a run that was cut short."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.functions.dates import as_timestamp
from ranklake.schemas import RESUME
from ranklake.session import delete_path


class ResumeNotFound(LookupError):
    """No saved work for the job."""


_KEYS = ["job_type", "job_id"]


def resume_rows(
    left: DataFrame, item: str, job_type: str, job_id: str, retry_after, saved_at, staging_path=None, shard=None
) -> DataFrame:
    """Ledger rows for the items in ``left``, which has a ``part`` column."""
    wait = retry_after if isinstance(retry_after, Column) else F.lit(retry_after)
    return left.select(
        F.lit(job_type).alias("job_type"),
        F.lit(job_id).alias("job_id"),
        F.col("part").cast("int").alias("part"),
        F.lit(shard).cast("int").alias("shard_id"),
        F.col(item).cast("string").alias("item"),
        F.lit(staging_path).cast("string").alias("staging_path"),
        wait.cast("double").alias("retry_after_seconds"),
        as_timestamp(saved_at).alias("checkpoint_timestamp"),
    )


def save_resume(df: DataFrame, root: str) -> None:
    """Save ledger rows; those of a job saved before are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_KEYS).json(root)


def _saved(spark: SparkSession, root: str, job_type: str, job_id: str) -> DataFrame | None:
    try:
        rows = spark.read.schema(RESUME).json(root)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.where((F.col("job_type") == job_type) & (F.col("job_id") == job_id))


def has_resume(spark: SparkSession, root: str, job_type: str, job_id: str) -> bool:
    rows = _saved(spark, root, job_type, job_id)
    return rows is not None and not rows.isEmpty()


def load_resume(spark: SparkSession, root: str, job_type: str, job_id: str) -> DataFrame:
    rows = _saved(spark, root, job_type, job_id)
    if rows is None or rows.isEmpty():
        raise ResumeNotFound(f"no saved work for {job_type}/{job_id}")
    return rows


def clear_resume(spark: SparkSession, root: str, job_type: str, job_id: str) -> bool:
    return delete_path(spark, f"{root}/job_type={job_type}/job_id={job_id}")
