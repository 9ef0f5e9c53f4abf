"""File streams that run to the end of what has arrived, and can be restarted at any point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.hashing import shard_of
from ranklake.operators.joins import mark
from ranklake.plans.registry import ledger_rows, read_ledger
from ranklake.sinks import versions
from ranklake.sinks.tables import append, newest_state, write_state
from ranklake.sources.parquet import scan_table


def stream_new(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the Parquet files under ``path`` that the stream has not read yet."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_end(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all files that have arrived, then stop. ``checkpoint`` remembers which ones."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_unseen(table: str, schema: StructType, keys: list[str], by: list[str] = ()) -> Callable:
    """Batch step: append the rows whose key the table does not hold yet.

    The table itself is the memory, so the stream keeps no growing state, and a batch that is
    run again after a failure adds nothing.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        stored = scan_table(batch.sparkSession, table, schema).select(*keys)
        fresh = batch.dropDuplicates(keys).join(stored, keys, "left_anti")
        append(fresh.select(*[f.name for f in schema]), table, by)

    return step


def mark_state(
    root: str,
    schema: StructType,
    key: str,
    values: dict,
    spread: list[str] | None = None,
    by: list[str] = ("shard_id",),
) -> Callable:
    """Batch step: set ``values`` on the state rows whose key arrives, as a new run of the state table.

    Runs are named after the batch, so one stream, with one checkpoint, owns a state table.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        run = f"batch-{batch_id:012d}"
        state = newest_state(batch.sparkSession, root, schema, run)
        write_state(mark(state, batch.select(key), key, values, spread), root, run, by)

    return step


def mark_shards(
    root: str,
    schema: StructType,
    key: str,
    values: dict,
    shards: int,
    spread: list[str] | None = None,
    shard: str = "shard_id",
) -> Callable:
    """As ``mark_state``, but a batch reads and writes only the shards of the keys that arrive.

    A key's shard must be that of ``assign_shard`` over ``shards``; null and unknown keys change nothing. Read the state with ``versions.read_shards``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, f"batch-{batch_id:012d}"
        keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
        known = versions.pointers(spark, root, shard, run)
        arrived = [s for s in versions.touched(keys, shard_of(key, shards)) if s in known]
        if arrived:
            state = versions.read_shards(spark, root, schema, arrived, shard, run)
            versions.write_shards(mark(state, keys, key, values, spread), root, run, arrived, shard)

    return step


def register_arrivals(ledger_path: str, table: str, registered_at) -> Callable:
    """Batch step: enter each arriving file with its row count into the file ledger.

    Needs the columns ``file_path`` and ``file_size`` of the file metadata.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        files = batch.groupBy("file_path").agg(F.count("*").alias("record_count"), F.max("file_size").alias("bytes"))
        ledger = read_ledger(batch.sparkSession, ledger_path)
        append(ledger_rows(ledger, files, table, registered_at), ledger_path)

    return step
