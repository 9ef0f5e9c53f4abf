"""Output of a run that was cut short, kept until the run is resumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ranklake.session import delete_path, path_exists


class StageNotFound(LookupError):
    """No staged output for the job."""


def _path(root: str, job_type: str, job_id: str) -> str:
    return f"{root}/job_type={job_type}/job_id={job_id}"


def stage(df: DataFrame, root: str, job_type: str, job_id: str) -> str:
    """Keep partial output, in the columns of the final output. What the job staged before is replaced."""
    path = _path(root, job_type, job_id)
    df.write.mode("overwrite").parquet(path)
    return path


def has_stage(spark: SparkSession, root: str, job_type: str, job_id: str) -> bool:
    return path_exists(spark, _path(root, job_type, job_id))


def restore(spark: SparkSession, root: str, job_type: str, job_id: str, schema: StructType) -> DataFrame:
    if not has_stage(spark, root, job_type, job_id):
        raise StageNotFound(f"nothing staged for {job_type}/{job_id}")
    return spark.read.schema(schema).parquet(_path(root, job_type, job_id))


def with_staged(df: DataFrame, root: str, job_type: str, job_id: str) -> DataFrame:
    """New output together with what an earlier run had staged."""
    if not has_stage(df.sparkSession, root, job_type, job_id):
        return df
    return df.unionByName(restore(df.sparkSession, root, job_type, job_id, df.schema))


def drop_stage(spark: SparkSession, root: str, job_type: str, job_id: str) -> bool:
    return delete_path(spark, _path(root, job_type, job_id))
