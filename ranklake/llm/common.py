"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of ASCII white space, and of anything else. Fixed values.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def present(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def key_of(column: Column) -> Column:
    """A value as text that is never null, so that null is a join key like any other."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) from the MD5 of ``columns``: the same on every run and engine."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    digits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (digits + 0.5) / float(1 << 48)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        number = 0
        while (own := f"_{name}_{number}") in taken:
            number += 1
        out.append(own)
    return out


def first_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key: used where rows of a key are the same, and already lie together and in order, so nothing is sorted again."""
    return rows.dropDuplicates(keys)


def dense_table(cells: DataFrame, size_log: int, dtype: str) -> np.ndarray:
    """An array of ``2 ** size_log`` numbers from rows of ``place`` and ``value``, each place once; 0 elsewhere.

    Tasks fill blocks of the array, so what reaches the driver is the array itself, whatever the number of rows.
    """
    block_log = min(size_log, 14)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            place, value = batch["place"].to_numpy(), batch["value"].to_numpy()
            for block in np.unique(place >> block_log).tolist():
                own = place >> block_log == block
                here = blocks.setdefault(block, np.zeros(1 << block_log, dtype))
                here[place[own] & (1 << block_log) - 1] = value[own]
        for block, data in blocks.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block]), "data": pa.array([data.tobytes()], pa.binary())})

    block = F.shiftright("place", block_log)
    filled = cells.select("place", "value").repartition(partitions(cells), block).mapInArrow(fill, "block long, data binary")
    table = np.zeros(1 << size_log, dtype)
    for row in filled.toLocalIterator():
        table[row.block << block_log : (row.block + 1) << block_log] = np.frombuffer(row.data, dtype)
    return table
