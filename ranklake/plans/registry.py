"""Table registration and the ledger of registered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.dates import as_timestamp
from ranklake.operators.joins import new_files
from ranklake.plans import ladder, match_ids, matches
from ranklake.schemas import FILE_LEDGER, LADDER_STORED, MATCHES, REGISTERED_TABLES
from ranklake.session import path_exists
from ranklake.sinks.tables import append, conform
from ranklake.sources.files import file_stats, list_files
from ranklake.sources.parquet import scan_table


def ensure_table(spark: SparkSession, name: str, schema: StructType, by: list[str], path: str) -> None:
    """Create the external table unless it exists. ``schema`` includes the partition columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    folders = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) " if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {folders}LOCATION '{path}'")


_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def refresh_table(spark: SparkSession, name: str, by: list[str], files: DataFrame) -> None:
    """Let the catalog see the folders of ``files`` (``file_path``), which were added outside of it."""
    if by:
        values = [F.url_decode(F.regexp_extract("file_path", rf"/{c}=([^/]*)/", 1)).alias(c) for c in by]
        found = files.select(*values).distinct().collect()  # the folders of one run
        for at in range(0, len(found), 100):
            folders = " ".join(f"PARTITION ({', '.join(_equal(c, row[c]) for c in by)})" for row in found[at : at + 100])
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {folders}")
    spark.catalog.refreshTable(name)


def _equal(column: str, value: str) -> str:
    quoted = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"`{column}` = {'NULL' if value == _NULL_FOLDER else quoted}"


def lake_tables(lake: str, database: str = "default") -> list[tuple]:
    """The three tables of the lake, in the form that ``sync`` takes."""
    dated = StructType([*MATCHES.fields])
    for name in ("year", "month", "date"):
        dated = dated.add(name, "integer")
    kinds = {
        "league": (LADDER_STORED, ladder.FOLDERS),
        "match_id": (match_ids.STORED, match_ids.FOLDERS),
        "match": (dated, matches.FOLDERS),
    }
    return [(f"{database}.{name}", f"{lake}/{folder}", *kinds[name]) for name, folder in REGISTERED_TABLES.items()]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return scan_table(spark, path, FILE_LEDGER)


def current_snapshot(ledger: DataFrame, table: str) -> int:
    """Newest snapshot of a table, 0 if it has none."""
    return ledger.where(F.col("table_name") == table).agg(F.max("snapshot_id")).first()[0] or 0


def ledger_rows(ledger: DataFrame, files: DataFrame, table: str, registered_at) -> DataFrame:
    """Ledger rows, under the next snapshot, for the files that are not registered yet."""
    own = ledger.where(F.col("table_name") == table)
    newest = own.agg(F.max("snapshot_id")).scalar()
    return new_files(files, own).select(
        F.lit(table).alias("table_name"),
        "file_path",
        F.col("record_count").cast("long").alias("record_count"),
        F.col("bytes").cast("long").alias("bytes"),
        (F.coalesce(newest, F.lit(0)) + 1).cast("long").alias("snapshot_id"),
        as_timestamp(registered_at).alias("registered_at"),
    )


def register(spark: SparkSession, ledger_path: str, table: str, path: str, registered_at) -> int:
    """Register the new files under ``path``; return their snapshot, or the current one if none is new.

    Files are compared by listing first. Only files as young as the oldest new one are opened to
    count their rows, so a daily run does not touch what it registered before.
    """
    ledger = read_ledger(spark, ledger_path)
    own = ledger.where(F.col("table_name") == table)
    oldest = new_files(list_files(spark, path), own).agg(F.min("modified_at")).first()[0]
    if oldest is not None:
        files = file_stats(spark, path, since=oldest)
        append(conform(ledger_rows(ledger, files, table, registered_at), FILE_LEDGER), ledger_path)
    return current_snapshot(read_ledger(spark, ledger_path), table)


def sync(spark: SparkSession, ledger_path: str, tables: list[tuple], registered_at) -> DataFrame:
    """Register the new files of every table; one summary row per table.

    ``tables`` holds ``(name, path, schema, partition columns)``. A second call finds nothing new.
    """
    out = []
    for name, path, schema, by in tables:
        ensure_table(spark, name, schema, by, path)
        before = current_snapshot(read_ledger(spark, ledger_path), name)
        snapshot = before
        if path_exists(spark, path):
            snapshot = register(spark, ledger_path, name, path, registered_at)
            new = (F.col("table_name") == name) & (F.col("snapshot_id") > before)
            refresh_table(spark, name, by, read_ledger(spark, ledger_path).where(new))
        out.append((name, snapshot, snapshot > before))
    runs = spark.createDataFrame(out, "table_name string, snapshot_id long, changed boolean")
    added = read_ledger(spark, ledger_path).groupBy("table_name", "snapshot_id").agg(F.count("*").alias("files"))
    return runs.join(added, ["table_name", "snapshot_id"], "left").select(
        "table_name",
        F.when(F.col("changed"), F.col("files")).otherwise(0).cast("long").alias("registered"),
        "snapshot_id",
    )
