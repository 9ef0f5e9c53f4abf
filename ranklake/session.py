"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster, pass your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ranklake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set on the context.

    Only a local session may go without one: it then gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ranklake-"))
    return context.getCheckpointDir()


_used: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _used.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this process wrote to the shared folder, once no frame reads it any more."""
    while _used:
        delete_path(spark, _used.pop())


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later reads do not run the plan again, and survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.delete(p, True)


def match_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob. Meant for short lists such as the versions of a table."""
    fs, p = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))
