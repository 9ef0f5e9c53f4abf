"""State as a base and a log of what came after it.

A state table whose rows are only ever added or finished need not be rewritten by every run. Runs write ``delta=<run>``
(new rows), ``done=<run>`` (keys that are finished) and ``files=<run>`` (what they have read) beside the newest
``run=<run>``, the base; a compaction writes the next base. Run names sort in time order, and that order decides: a base
holds all runs up to its own name, and a key is finished in the rows of earlier runs than the one that finished it.
Nothing has to be deleted for a reader to be right, and a repeated run replaces only its own folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.operators.skew import join_unique
from ranklake.session import delete_path, match_paths
from ranklake.sinks.tables import state_runs, write_state
from ranklake.sources.parquet import scan_table

_KINDS = ("delta", "done", "files")


def _run_of(folder: str) -> str:
    return folder.rstrip("/").rsplit("=", 1)[1]


def _folders(spark: SparkSession, root: str, kind: str, after: str, before: str | None) -> list[str]:
    found = [p.rsplit("/", 1)[0] for p in match_paths(spark, f"{root}/{kind}=*/_SUCCESS")]
    return [p for p in found if _run_of(p) > after and (before is None or _run_of(p) < before)]


def _base(spark: SparkSession, root: str, before: str | None) -> tuple[str | None, str]:
    """The folder of the newest base and its run, which sorts before all others if there is none."""
    runs = state_runs(spark, root, before)
    return (runs[-1], _run_of(runs[-1])) if runs else (None, "")


def write_delta(df: DataFrame, root: str, run: str, by: list[str] = ("shard_id",)) -> str:
    """Rows that are new in ``run``."""
    path = f"{root}/delta={run}"
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def write_done(keys: DataFrame, root: str, run: str) -> str:
    """Keys that ``run`` has finished, in all rows of earlier runs."""
    path = f"{root}/done={run}"
    keys.distinct().write.mode("overwrite").parquet(path)
    return path


READ = StructType().add("file_path", "string").add("newest", "timestamp")


def write_files(files: DataFrame, root: str, run: str) -> str:
    """What ``run`` has read: each ``file_path`` and the ``newest`` stamp in it, so that the next run reads only others."""
    path = f"{root}/files={run}"
    files.select(*READ.names).write.mode("overwrite").parquet(path)
    return path


def files_read(spark: SparkSession, root: str, before: str) -> DataFrame:
    """Files that runs before ``before`` have read, those of the base included."""
    folders = _folders(spark, root, "files", "", before)
    return spark.read.schema(READ).parquet(*folders) if folders else spark.createDataFrame([], READ)


def read_state(
    spark: SparkSession, root: str, schema: StructType, key: str, spread: list[str], before: str | None = None, flag: str = "is_ingested"
) -> DataFrame:
    """The state after all complete runs, or after those before ``before``."""
    base, name = _base(spark, root, before)
    rows = (scan_table(spark, base, schema) if base else spark.createDataFrame([], schema)).withColumn("_run", F.lit(name))
    for folder in _folders(spark, root, "delta", name, before):
        rows = rows.unionByName(scan_table(spark, folder, schema).withColumn("_run", F.lit(_run_of(folder))))
    finished = _folders(spark, root, "done", name, before)
    if finished:
        kind = StructType().add(schema[key])
        done = None
        for folder in finished:
            one = spark.read.schema(kind).parquet(folder).withColumn("_done_in", F.lit(_run_of(folder)))
            done = one if done is None else done.unionByName(one)
        newest = done.groupBy(key).agg(F.max("_done_in").alias("_done_in"))
        rows = join_unique(rows, newest, [key], "left", spread)
        hit = F.coalesce(F.col("_done_in") > F.col("_run"), F.lit(False))
        rows = rows.withColumn(flag, F.when(hit, F.lit(1)).otherwise(F.col(flag)).cast("int"))
    return rows.select(*[f.name for f in schema])


def compact_state(
    spark: SparkSession, root: str, schema: StructType, key: str, spread: list[str], run: str, by: list[str] = ("shard_id",)
) -> str:
    """Write base, deltas and finished keys as the next base, under the name ``run``, which must sort after all of them."""
    late = [f for kind in _KINDS for f in _folders(spark, root, kind, run, None)]
    if late:
        raise ValueError(f"{run} is older than {_run_of(late[0])}")
    # Itself left out: an attempt under this name that died, or one that is repeated.
    earlier = read_state(spark, root, schema, key, spread, run)
    return write_state(earlier, root, run, list(by))


def drop_compacted(spark: SparkSession, root: str) -> int:
    """Delete deltas and finished keys that the newest base holds. What was read stays known."""
    _, name = _base(spark, root, None)
    old = [f for kind in ("delta", "done") for f in _folders(spark, root, kind, "", None) if _run_of(f) <= name]
    for folder in old:
        delete_path(spark, folder)
    return len(old)
