"""Partitions of a table replaced so that no moment of the replacement can lose rows.

The new rows are written whole beside the table. A small commit record then makes them the truth: from there on
readers take these partitions from the journal, and whoever comes next carries the replacement to its end. Only after that is
the journal dropped. A run that dies before the record has changed nothing; one that dies after it has lost nothing.

One writer at a time is assumed. A writer calls ``recover`` before it appends to a table that others replace.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.session import delete_path, path_exists
from ranklake.sinks import tables
from ranklake.sinks.tables import overwrite_lying as overwrite_partitions
from ranklake.sources.parquet import scan_with_source

_RECORD = "schema string, by array<string>, drops array<string>"


def journal_path(table: str) -> str:
    return f"{table.rstrip('/')}-journal"


def _pending(spark: SparkSession, table: str):
    """The commit record of a replacement that is not finished."""
    record = f"{journal_path(table)}/commit"
    if not path_exists(spark, f"{record}/_SUCCESS"):
        return None
    return spark.read.schema(_RECORD).json(record).first()


def _rows(spark: SparkSession, table: str, record) -> DataFrame:
    schema = StructType.fromJson(json.loads(record.schema))
    return scan_with_source(spark, f"{journal_path(table)}/rows", schema, partitioned=True)


def prepare(df: DataFrame, table: str, by: list[str], drops: list[str] = ()) -> None:
    """Write the new rows of the partitions that ``df`` has rows for, and commit. ``drops``: paths to delete afterwards."""
    spark = df.sparkSession
    root = journal_path(table)
    delete_path(spark, root)  # what an attempt left that never committed
    overwrite_partitions(tables._grouped(df, by), f"{root}/rows", by)
    record = [(df.schema.json(), list(by), list(drops))]
    spark.createDataFrame(record, _RECORD).coalesce(1).write.json(f"{root}/commit")


def recover(spark: SparkSession, table: str) -> bool:
    """Carry a committed replacement to its end. True if there was one. Can be repeated at any point."""
    record = _pending(spark, table)
    if record is None:
        return False
    rows = _rows(spark, table, record).drop("source_file_path", "source_row")
    overwrite_partitions(rows, table, record.by)
    for path in record.drops:
        delete_path(spark, path)
    delete_path(spark, f"{journal_path(table)}/commit")
    delete_path(spark, journal_path(table))
    return True


def replace_partitions(df: DataFrame, table: str, by: list[str], drops: list[str] = ()) -> None:
    """Replace the partitions that ``df`` has rows for; ``df`` may read the table itself."""
    recover(df.sparkSession, table)
    prepare(df, table, by, drops)
    recover(df.sparkSession, table)


def dropped(spark: SparkSession, table: str) -> list[str]:
    """Paths that a committed replacement has taken the place of."""
    record = _pending(spark, table)
    return list(record.drops) if record else []


def scan_published(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """``scan_with_source`` of a partitioned table, whatever became of a committed replacement of some partitions."""
    rows = scan_with_source(spark, table, schema, partitioned=True)
    record = _pending(spark, table)
    if record is None:
        return rows
    new = _rows(spark, table, record).select(*rows.columns)
    touched = new.select(*[F.col(c).alias(f"_new_{c}") for c in record.by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in record.by]
    return rows.join(touched, same, "left_anti").unionByName(new)
