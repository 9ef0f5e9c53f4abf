"""File listings as DataFrames."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_ALL = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def _since(since: datetime | None) -> dict[str, str]:
    if since is None:
        return {}
    just_before = since.astimezone(UTC) - timedelta(milliseconds=1)
    return {"modifiedAfter": f"{just_before:%Y-%m-%dT%H:%M:%S.%f}", "timeZone": "UTC"}


def list_files(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """Parquet files under ``path`` with size and time. No file is opened: the content is not selected."""
    return (
        spark.read.format("binaryFile")
        .options(**_ALL, **_since(since))
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )


def file_stats(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """Rows and bytes per Parquet file, of the files written at ``since`` or later if given.

    Reads no column, so the row counts come from the footers; older files are not opened at all.
    A file without rows has none in the scan, and counts 0 by the listing.
    """
    listed = list_files(spark, path, since).select("file_path", "bytes")
    rows = spark.read.options(**_ALL, **_since(since)).parquet(path).select("_metadata.file_path")
    counted = rows.groupBy("file_path").agg(F.count("*").alias("record_count"))
    return listed.join(counted, "file_path", "left").select(
        "file_path", F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count"), "bytes"
    )
