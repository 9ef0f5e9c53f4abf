"""Writes of Parquet tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ranklake.session import delete_path, match_paths
from ranklake.sources.parquet import scan_table

#: Row groups of a file, where these are limited.
GROUPS_PER_FILE = 256


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns and types of ``schema``; a missing column is an error."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])


def _as_is(df: DataFrame) -> DataFrame:
    return df


def append(df: DataFrame, path: str, by: list[str] = ()) -> None:
    """Add files to a table. Their names never clash with those of another run."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str], rows_per_file: int = 0) -> None:
    """Replace the partitions that ``df`` has rows for; leave the others."""
    overwrite_lying(_grouped(df, by), path, by, rows_per_file)


def overwrite_lying(df: DataFrame, path: str, by: list[str], rows_per_file: int = 0) -> None:
    """The same for rows that lie grouped already, such as those of a table written by ``by``: they are not shuffled."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def _grouped(df: DataFrame, by: list[str]) -> DataFrame:
    # Brings the rows of a partition together, and splits one that is too big for a task.
    return df.hint("rebalance", *by) if by else df


def write_partitioned(
    df: DataFrame,
    path: str,
    by: list[str],
    rows_per_file: int = 0,
    rows_per_group: int | None = None,
    mode: str = "append",
    seen: Callable[[DataFrame], DataFrame] = _as_is,
) -> None:
    """Write one folder per value of ``by``, with few files per folder and bounded rows per file.

    ``rows_per_group`` limits the rows of a row group, for readers that hold a group in memory, and a file then has at most
    ``GROUPS_PER_FILE`` groups: writers and readers hold what describes all groups of a file. Left out, groups grow to Spark's
    default size, which scans faster.
    ``seen`` is applied to the rows as they are written, to count them.
    """
    if rows_per_group:
        rows_per_file = min(rows_per_file or sys.maxsize, rows_per_group * GROUPS_PER_FILE)
    writer = seen(_grouped(df, by)).write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if not rows_per_group:
        writer.partitionBy(*by).parquet(path)
        return
    # Small groups make open files cheap, so a task keeps some open rather than sort all of its rows by folder.
    with _files_open(df.sparkSession):
        writer.option("parquet.block.row.count.limit", rows_per_group).partitionBy(*by).parquet(path)


@contextmanager
def _files_open(spark: SparkSession, most: int = 64) -> Iterator[None]:
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# A state table is rewritten whole by every run, from its own rows. Each run writes a folder of
# its own, and readers take the newest complete one, so a failed run leaves the old state whole.


def write_state(
    df: DataFrame, root: str, run: str, by: list[str] = ("shard_id",), seen: Callable[[DataFrame], DataFrame] = _as_is
) -> str:
    """Write the state of ``run``. Run names must sort in time order; a repeated run replaces its own folder."""
    path = f"{root}/run={run}"
    seen(_grouped(df, list(by))).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def state_runs(spark: SparkSession, root: str, before: str | None = None) -> list[str]:
    """Folders of the complete runs, oldest first; only those before ``before``, if given."""
    folders = [p.rsplit("/", 1)[0] for p in match_paths(spark, f"{root}/run=*/_SUCCESS")]
    return [p for p in folders if before is None or p.rsplit("/run=", 1)[1] < before]


def newest_state(spark: SparkSession, root: str, schema: StructType, before: str | None = None) -> DataFrame:
    """Rows of the newest complete run; none before the first.

    A run passes its own name as ``before``, so that it never reads the folder it is to write.
    """
    runs = state_runs(spark, root, before)
    return scan_table(spark, runs[-1], schema) if runs else spark.createDataFrame([], schema)


def drop_old_state(spark: SparkSession, root: str, keep: int = 2) -> None:
    for path in state_runs(spark, root)[:-keep]:
        delete_path(spark, path)
