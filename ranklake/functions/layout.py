"""Paths of the bare-value layout: built from columns, and read back into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The folders of the layout; {x} stands for a column.
LAYOUT = {
    "league": "league/{region}/{platform}/{tier}/{division}/",
    "match_id": "matchID/{region}/{platform}/{puuid}/",
    "match": "match/{region}/{platform}/{year}/{month}/{date}/",
    "player_shard": "workspace/puuid/{shard_id}/",
    "match_shard": "workspace/matchid/{shard_id}/",
    "staging": "workspace/tmp/{job_type}/{job_id}_{part}.parquet",
    "resume": "state/checkpoint/{job_type}/{job_id}_{part}.json",
    "table": "iceberg/{table_name}/",
}


def _text(name: str) -> Column:
    if name == "tier":
        return F.lower("tier")
    if name == "division":
        return F.coalesce(F.col("division"), F.lit("all"))
    return F.col(name).cast("string")


def layout_path(kind: str) -> Column:
    """Path of a row in the layout ``kind``, from the columns the pattern names."""
    pieces: list[Column] = []
    rest = LAYOUT[kind]
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), _text(name)]
    return F.concat(*pieces, F.lit(rest))


def table_uri(base: str | Column, path: str | Column, scheme: str = "gs") -> Column:
    """Bucket (with or without scheme) and path joined into one URI."""
    bucket = F.regexp_replace(F.lit(base) if isinstance(base, str) else base, f"^{scheme}://", "")
    tail = F.ltrim(path if isinstance(path, Column) else F.lit(path), F.lit("/"))
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), tail)


def partition_text(*columns: str) -> Column:
    """Partition key as one text, numbers below ten with a leading zero after the first three."""
    parts = [
        F.col(c).cast("string") if i < 3 else F.format_string("%02d", F.col(c)) for i, c in enumerate(columns)
    ]
    return F.concat_ws("_", *parts)


def with_path_columns(df: DataFrame, names: list[str], path: str | Column = "source_file_path") -> DataFrame:
    """Add the folder names above each file as columns, the last folder being ``names[-1]``."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    return df.withColumns({name: F.element_at(parts, i - len(names) - 1) for i, name in enumerate(names)})


def file_name(path: str | Column) -> Column:
    return F.element_at(F.split(F.col(path) if isinstance(path, str) else path, "/"), -1)
