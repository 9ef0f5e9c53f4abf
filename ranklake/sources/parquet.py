"""Scans of the Parquet files under a path."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.operators.dedup import latest_by
from ranklake.operators.filters import valid_key


def _read(spark: SparkSession, path: str, schema: StructType, options: dict) -> DataFrame | None:
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


_FLAT = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}


def scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the ``*.parquet`` files anywhere under ``path``; no rows if it does not exist."""
    found = _read(spark, path, schema, _FLAT)
    return spark.createDataFrame([], schema) if found is None else found


def scan_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a table written with partition folders, which filters on those columns prune."""
    found = _read(spark, path, schema, {})
    return spark.createDataFrame([], schema) if found is None else found


def scan_with_source(spark: SparkSession, path: str, schema: StructType, partitioned: bool = False) -> DataFrame:
    """``scan`` plus the file each row came from and its place in that file."""
    found = _read(spark, path, schema, {} if partitioned else _FLAT)
    return _sourced(spark, found, schema)


def scan_files(spark: SparkSession, table: str, files: list[str], schema: StructType) -> DataFrame:
    """Rows of the given files of a partitioned table, each with its file and place. Others are not opened."""
    found = spark.read.schema(schema).option("basePath", table).parquet(*map(unquote, files)) if files else None
    return _sourced(spark, found, schema)


def _sourced(spark: SparkSession, found: DataFrame | None, schema: StructType) -> DataFrame:
    if found is None:
        sourced = StructType([*schema.fields]).add("source_file_path", "string").add("source_row", "long")
        return spark.createDataFrame([], sourced)
    return found.select(
        *[f.name for f in schema],
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.row_index").alias("source_row"),
    )


def scan_tolerant(
    spark: SparkSession, path: str, schema: StructType, defaults: dict | None = None, skip_corrupt: bool = False
) -> DataFrame:
    """``scan`` where files may lack columns: these read as NULL, or as their default.

    With ``skip_corrupt`` an unreadable file is left out; Spark logs a warning for it.
    """
    found = _read(spark, path, schema, {**_FLAT, "ignoreCorruptFiles": str(skip_corrupt).lower()})
    if found is None:
        return spark.createDataFrame([], schema)
    return fill_defaults(found, defaults or {})


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)).cast(df.schema[c].dataType) for c, v in defaults.items()}
    )


def last_shard_wins(state: DataFrame, key: str, shard: str = "shard_id") -> DataFrame:
    """One row per valid key; of a key stored in several shards, the row of the highest one."""
    return latest_by(valid_key(state, key), [key], [shard])


def read_state(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """All shards of a state table, one row per key. No rows before the first run."""
    return last_shard_wins(scan_table(spark, path, schema), key)


def concat_strict(frames: list[DataFrame], spark: SparkSession, schema: StructType) -> DataFrame:
    """All rows of frames with the same columns; no frames give no rows."""
    out = spark.createDataFrame([], schema) if not frames else frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def concat_tolerant(
    frames: list[DataFrame], spark: SparkSession, schema: StructType, defaults: dict | None = None
) -> DataFrame:
    """All rows of frames that may lack columns: these become NULL, or their default."""
    out = spark.createDataFrame([], schema)
    for frame in frames:
        out = out.unionByName(frame, allowMissingColumns=True)
    return fill_defaults(out.select(*[f.name for f in schema]), defaults or {})
