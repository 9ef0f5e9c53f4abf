"""Row numbers over data of any size, without one task seeing a whole group.

The rows are range-partitioned by group and order, sorted, and written once to the shared
folder: one file per range. A row's number is then the rows of the files before its own plus
its place in the file, and both come from the files themselves. A large group simply spans
many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ranklake.functions.text import key_text
from ranklake.schemas import ROW_BYTES
from ranklake.session import settle


def laid_out(df: DataFrame, order: list[str], by: list[str] = ()) -> tuple[DataFrame, DataFrame, list[str]]:
    """``df`` in order of ``by`` and ``order``, written once: one file per range.

    Returns the rows with their ``_file``, ``_index`` in it and group columns; the spans, one row for each file and
    group (``_number`` of the file, ``_rows``, ``_least`` index); and the names of the group columns.
    """
    groups = {f"_group{i}": key_text(c) for i, c in enumerate(by)}
    # Rows that are equal in all keys may still go to several ranges, by a hash of the rest.
    flat = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    keys = [*by, *order, F.xxhash64(F.lit("tie"), *flat)]
    ordered = settle(df.repartitionByRange(*keys).sortWithinPartitions(*keys), "ordered")
    file = F.col("_metadata.file_path").alias("_file")
    rows = ordered.select(*df.columns, file, F.col("_metadata.row_index").alias("_index")).withColumns(groups)
    # Written, so that Spark knows its size when it plans the joins.
    spans = rows.groupBy("_file", *groups).agg(F.count("*").alias("_rows"), F.min("_index").alias("_least"))
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long").alias("_number")
    return rows, settle(spans.select(number, *spans.columns), "spans"), list(groups)


def numbered(df: DataFrame, order: list[str], by: list[str] = (), name: str = "row_no") -> DataFrame:
    """Add the 0-based place of each row in ``order`` within ``by``.

    Rows that are equal in all of ``order`` come in any order, but each gets its own number. A row's number is that
    of its span and its place in it, so rows meet only the spans: by broadcast where these are known to be few.
    """
    rows, spans, groups = laid_out(df, order, by)
    before = Window.partitionBy(*groups).orderBy("_number", "_file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_least")
    bases = settle(spans.select("_file", *groups, base.alias("_base")), "bases")
    placed = rows.join(bases, ["_file", *groups])
    return placed.select(*df.columns, (F.col("_base") + F.col("_index")).alias(name))


def split_even(df: DataFrame, parts: int, order: list[str]) -> DataFrame:
    """Add ``part``: runs of equal length in ``order``, the first ones taking the remainder."""
    if parts < 1:
        raise ValueError(f"parts must be at least 1, got {parts}")
    rows = numbered(df, order, name="_row")
    total = rows.agg(F.count("*")).scalar()
    small = F.floor(total / parts).cast("long")
    extra = total - small * parts
    longer = extra * (small + 1)
    row = F.col("_row")
    part = F.when(row < longer, F.floor(row / (small + 1))).otherwise(
        extra + F.floor((row - longer) / F.greatest(small, F.lit(1)))
    )
    return rows.withColumn("part", part.cast("int")).drop("_row")


def rows_per_file(threshold: int, row_bytes: float = ROW_BYTES) -> int:
    """Rows after which a file reaches ``threshold`` bytes."""
    if threshold < 1 or row_bytes <= 0:
        raise ValueError("threshold and row size must be positive")
    return max(1, int(-(-threshold // row_bytes)))


def measured_row_bytes(df: DataFrame) -> float:
    """Mean encoded size of a row, over all rows."""
    size = df.agg(F.avg(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0]
    return float(size or ROW_BYTES)


def chunk_files(
    df: DataFrame, by: list[str], order: list[str], threshold: int, row_bytes: float | str = ROW_BYTES
) -> DataFrame:
    """Add ``file_no``: the file within the partition ``by`` that each row falls into.

    ``row_bytes`` is a size, or ``'measured'`` for the mean encoded size.
    """
    size = measured_row_bytes(df) if row_bytes == "measured" else row_bytes
    limit = rows_per_file(threshold, size)
    return (
        numbered(df, order, by, name="_row").withColumn("file_no", F.floor(F.col("_row") / limit)).drop("_row")
    )
