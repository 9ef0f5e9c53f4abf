"""What each work item of a run came to, beside the table that its rows go to.

A partition overwrite only touches folders that get rows, so an item that has none any more keeps what an earlier run of
the day wrote. The record of an item says so: readers leave its rows out from then on, and its folder is deleted.
A run that dies before its record leaves the last one in force; one that dies after it has nothing left to lose.
One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.dates import as_timestamp
from ranklake.session import delete_path, match_paths, settle
from ranklake.sinks.tables import append
from ranklake.sources.parquet import scan_table


def items_path(table: str) -> str:
    return f"{table.rstrip('/')}-items"


def _schema(df: DataFrame, by: list[str]) -> StructType:
    fixed = StructType().add("stamp", "timestamp").add("number", "long").add("empty", "boolean")
    return StructType([*[df.schema[c] for c in by[1:]], *fixed.fields, df.schema[by[0]]])


def record_items(items: DataFrame, table: str, by: list[str], stamp) -> None:
    """Record finished items: ``by``, which names folders from the day on, and whether the item is ``empty``."""
    spark, path = items.sparkSession, items_path(table)
    days = settle(items.select(*by, "empty"), "items")
    before = scan_table(spark, path, _schema(days, by)).join(days.select(by[0]).distinct(), by[0], "left_semi")
    number = before.agg(F.coalesce(F.max("number"), F.lit(0)) + 1).first()[0]
    rows = days.withColumns({"stamp": as_timestamp(stamp), "number": F.lit(number).cast("long")})
    append(rows.coalesce(1), path, [by[0]])


def emptied(spark: SparkSession, table: str, schema: StructType, by: list[str]) -> DataFrame:
    """``by, stamp`` of the items whose last record says that they are empty. At most one row per item and day."""
    like = scan_table(spark, table, schema)
    records = scan_table(spark, items_path(table), _schema(like, by))
    last = records.groupBy(*by).agg(F.max_by(F.struct("empty", "stamp"), "number").alias("last"))
    return settle(last.where("last.empty").select(*by, "last.stamp"), "emptied")


def scan_items(spark: SparkSession, table: str, schema: StructType, by: list[str], at: str = "_ingested_at") -> DataFrame:
    """Rows of the table without those of items found empty since. Rows of a later stamp than the record stay."""
    rows = scan_table(spark, table, schema)
    if not match_paths(spark, items_path(table)):
        return rows
    gone = emptied(spark, table, schema, by).toDF(*[f"_gone_{c}" for c in by], "_gone_at")
    same = [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in by]
    return rows.join(gone, [*same, F.col(at) <= F.col("_gone_at")], "left_anti")


def clear_emptied(spark: SparkSession, table: str, schema: StructType, by: list[str], at: str = "_ingested_at") -> int:
    """Delete the folders of items found empty, so that readers of the plain files see the same. Can be repeated.

    Of the items of a run, few have rows to lose: only their folders are listed.
    """
    gone = emptied(spark, table, schema, by).toDF(*[f"_gone_{c}" for c in by], "_gone_at")
    same = [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in by]
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    rows = scan_table(spark, table, schema).select(*by, at, folder.alias("folder"))
    old = rows.join(gone, [*same, F.col(at) <= F.col("_gone_at")], "left_semi")
    folders = [r.folder for r in old.select("folder").distinct().toLocalIterator()]
    for path in folders:
        delete_path(spark, path)
    return len(folders)
