"""State by versions that name, for each shard, the folder it was last written in.

A version writes only the shards it changes, to ``part=<run>-<attempt>``, then a table of pointers, ``version=<run>``:
a row per shard with the part that holds it. Readers take the newest complete version, so one that dies half-way is never
seen, and an attempt that is repeated writes a part of its own. Before the first version the newest ``run=<run>``, a whole
state, holds all shards. Run names sort in time order. Pointers are as many as shards, so they pass through the driver;
rows and keys do not. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.session import delete_path, match_paths
from ranklake.sinks.tables import state_runs
from ranklake.sources.parquet import scan_table

_POINTERS = StructType().add("shard", "integer").add("part", "string")


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[1]


def _versions(spark: SparkSession, root: str, before: str | None = None) -> list[str]:
    folders = [p.rsplit("/", 1)[0] for p in match_paths(spark, f"{root}/version=*/_SUCCESS")]
    return [p for p in folders if before is None or p.rsplit("/version=", 1)[1] < before]


def _pointers_of(spark: SparkSession, version: str) -> dict[int, str]:
    return {r.shard: r.part for r in spark.read.schema(_POINTERS).parquet(version).collect()}


def pointers(spark: SparkSession, root: str, shard: str = "shard_id", before: str | None = None) -> dict[int, str]:
    """The folder below ``root`` that holds each shard, in the newest complete version (``before`` a run, if given)."""
    found = _versions(spark, root, before)
    if found:
        return _pointers_of(spark, found[-1])
    whole = state_runs(spark, root, before)
    if not whole:
        return {}
    shards = [p.rsplit(f"/{shard}=", 1)[1] for p in match_paths(spark, f"{whole[-1]}/{shard}=*")]
    if not all(s.isdigit() for s in shards):
        raise ValueError(f"{shard} must be a number in every row of {whole[-1]}")
    return {int(s): _name(whole[-1]) for s in shards}


def read_shards(
    spark: SparkSession,
    root: str,
    schema: StructType,
    only: list[int] | None = None,
    shard: str = "shard_id",
    before: str | None = None,
) -> DataFrame:
    """Rows of the newest complete version; with ``only``, of these shards, whose folders alone are read."""
    parts: dict[str, list[int]] = {}
    for number, part in pointers(spark, root, shard, before).items():
        if only is None or number in only:
            parts.setdefault(part, []).append(number)
    out = None
    for part in sorted(parts):
        rows = scan_table(spark, f"{root}/{part}", schema).where(F.col(shard).isin(parts[part]))
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def write_shards(df: DataFrame, root: str, run: str, shards: list[int], shard: str = "shard_id") -> str:
    """A version in which ``df`` holds all rows of ``shards``; the others stay where they are. A shard without rows is gone."""
    spark = df.sparkSession
    named = pointers(spark, root, shard, run)
    part = f"part={run}-{uuid.uuid4().hex}"
    df.hint("rebalance", shard).write.partitionBy(shard).parquet(f"{root}/{part}")
    written = {int(p.rsplit("=", 1)[1]) for p in match_paths(spark, f"{root}/{part}/{shard}=*")}
    if not written <= set(shards):
        raise ValueError(f"rows of shards {sorted(written - set(shards))} in a version of {sorted(shards)}")
    named = {s: p for s, p in named.items() if s not in shards} | dict.fromkeys(written, part)
    path = f"{root}/version={run}"
    spark.createDataFrame(sorted(named.items()), _POINTERS).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def touched(keys: DataFrame, shard_of: Column) -> list[int]:
    """The shards of some keys: at most as many as there are shards."""
    return sorted(r[0] for r in keys.select(shard_of.alias("shard")).distinct().collect())


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest versions, and the parts that only these named. Returns how many folders went.

    Parts of the newest version and later are left, as a writer may be at work on them. Of the whole states (``run=``) those go
    that no kept version names.
    """
    found = _versions(spark, root)
    kept = found[-keep:]
    if not kept:
        return 0
    named = {part for version in kept for part in _pointers_of(spark, version).values()}
    newest = _name(kept[-1]).split("=", 1)[1]
    parts = [p for p in match_paths(spark, f"{root}/part=*") if _name(p).split("=", 1)[1].rsplit("-", 1)[0] < newest]
    old = found[:-keep] + [p for p in parts + state_runs(spark, root, newest) if _name(p) not in named]
    for folder in old:
        delete_path(spark, folder)
    return len(old)
