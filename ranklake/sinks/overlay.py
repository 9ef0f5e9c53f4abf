"""Flags kept beside a table, instead of rewriting the rows they belong to.

A run writes the ids it has finished to a folder of its own, under its scope and day. Readers join these with the
rows as they read them; a compaction now and then folds them into the rows of the partitions they touch. What a daily run
writes grows with what it finished, not with the table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.dates import as_timestamp
from ranklake.operators.skew import join_unique
from ranklake.session import delete_path, match_paths, settle
from ranklake.sinks import journal

ALL, LAST = "all", "last"


def overlay_path(table: str) -> str:
    return f"{table.rstrip('/')}-flags"


def write_flags(done: DataFrame, table: str, key: str, day: date | str, run: str, stamp, scope: str = ALL) -> str:
    """Flag the ids of ``done``; a repeated run replaces its own flags. Returns their folder.

    Scope ``all`` flags every row of an id that is as old as ``stamp``, ``last`` only those of the file that ``done`` names in
    ``source_file_path``.
    """
    if scope not in (ALL, LAST):
        raise ValueError(f"scope must be 'all' or 'last', got {scope!r}")
    source = F.col("source_file_path") if scope == LAST else F.lit(None).cast("string").alias("source_file_path")
    path = f"{overlay_path(table)}/scope={scope}/day={day}/run={run}"
    rows = done.select(key, source).distinct().withColumn("_flagged_at", as_timestamp(stamp))
    rows.write.mode("overwrite").parquet(path)
    return path


def flag_folders(spark: SparkSession, table: str, scope: str = "*") -> list[str]:
    """Folders of the complete runs whose flags are not folded into the table yet: one per run, by day."""
    folded = {_place(p) for p in journal.dropped(spark, table)}
    found = match_paths(spark, f"{overlay_path(table)}/scope={scope}/day=*/run=*/_SUCCESS")
    return [p.rsplit("/", 1)[0] for p in found if _place(p.rsplit("/", 1)[0]) not in folded]


def _place(path: str) -> str:
    """A folder of flags without the store it lies in, which listings add."""
    return path[path.index("/scope=") :]


def _flags(spark: SparkSession, folders: list[str], key: str, kind) -> DataFrame:
    schema = StructType().add(key, kind).add("source_file_path", "string").add("_flagged_at", "timestamp")
    return spark.read.schema(schema).parquet(*folders)


def merge_flags(
    rows: DataFrame, table: str, key: str, spread: list[str], folders: list[str], flag: str = "is_ingested", stamp: str = "_ingested_at"
) -> DataFrame:
    """``rows`` (with ``source_file_path``) under the flags of ``folders``; ``_was`` holds the stored flag."""
    spark, names = rows.sparkSession, rows.columns
    rows = rows.withColumns({"_was": F.col(flag), "_flag_all": F.lit(None).cast("timestamp"), "_flag_last": F.lit(None).cast("boolean")})
    held = [f for f in folders if f"/scope={ALL}/" in f]
    if held:
        newest = _flags(spark, held, key, rows.schema[key].dataType).groupBy(key).agg(F.max("_flagged_at").alias("_flag_all"))
        rows = join_unique(rows.drop("_flag_all"), newest, [key], "left", spread)
    held = [f for f in folders if f"/scope={LAST}/" in f]
    if held:
        chosen = _flags(spark, held, key, rows.schema[key].dataType).select(key, "source_file_path").distinct()
        chosen = chosen.withColumn("_flag_last", F.lit(True))
        rows = join_unique(rows.drop("_flag_last"), chosen, [key, "source_file_path"], "left", spread)
    # A row without a stamp is as old as any.
    old = F.col(stamp).isNull() | (F.col(stamp) <= F.col("_flag_all"))
    hit = F.coalesce(F.col("_flag_all").isNotNull() & old, F.lit(False)) | F.coalesce("_flag_last", F.lit(False))
    new = F.when(hit, F.lit(1)).otherwise(F.col("_was")).cast("int")
    return rows.withColumn(flag, new).select(*names, "_was")


def read_flagged(spark: SparkSession, table: str, schema: StructType, key: str, spread: list[str]) -> DataFrame:
    """The rows of the table with their flags as of now, and the file and place each came from."""
    rows = journal.scan_published(spark, table, schema)
    folders = flag_folders(spark, table)
    return merge_flags(rows, table, key, spread, folders).drop("_was") if folders else rows


def compact(spark: SparkSession, table: str, schema: StructType, key: str, by: list[str], spread: list[str]) -> int:
    """Fold the flags into the partitions in which they change one, and drop them. Returns the runs folded.

    A first pass reads keys only and finds these partitions; others are not opened again. The new rows are published
    through the journal, so a death at any point loses neither rows nor flags.
    """
    journal.recover(spark, table)
    folders = flag_folders(spark, table)
    if not folders:
        return 0
    rows = journal.scan_published(spark, table, schema)
    changed = merge_flags(rows, table, key, spread, folders).where(~F.col("is_ingested").eqNullSafe(F.col("_was")))
    touched = settle(changed.select(*[F.col(c).alias(f"_hit_{c}") for c in by]).distinct(), "touched")
    same = [F.col(c).eqNullSafe(F.col(f"_hit_{c}")) for c in by]
    affected = rows.join(touched, same, "left_semi")
    merged = merge_flags(affected, table, key, spread, folders).select(*[f.name for f in schema])
    if touched.isEmpty():
        for folder in folders:
            delete_path(spark, folder)
    else:
        journal.replace_partitions(merged, table, by, folders)
    return len(folders)
