"""Row filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklake.functions.dates import as_date, midnight_epoch
from ranklake.schemas import PAGE_SIZE, QUEUE


def valid_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is NULL or empty."""
    return df.where(F.col(key) != "")


def is_due(as_of: date | str | Column, last_read: str = "last_read") -> Column:
    return F.col(last_read).isNull() | (F.col(last_read) < as_date(as_of))


def due(df: DataFrame, as_of: date | str | Column, last_read: str = "last_read") -> DataFrame:
    """Rows never read, or last read before ``as_of``."""
    return df.where(is_due(as_of, last_read))


def pending(df: DataFrame, flag: str = "is_ingested") -> DataFrame:
    """Rows whose flag is 0. NULL is not pending."""
    return df.where(F.col(flag) == 0)


def since(
    df: DataFrame,
    last_read: str | Column | None = None,
    queue: int | str = QUEUE,
    queue_col: str = "queue",
    start_col: str = "game_start_timestamp",
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Rows of one queue that, where ``last_read`` is known, start on that day (UTC) or later.

    ``start_col`` is in epoch milliseconds. ``page_size`` is checked to be 1 to 100.
    """
    if not 1 <= page_size <= 100:
        raise ValueError(f"page_size must be 1 to 100, got {page_size}")
    rows = df.where(F.col(queue_col) == F.lit(queue))
    if last_read is None:
        return rows
    day = F.col(last_read) if isinstance(last_read, str) else last_read
    return rows.where(day.isNull() | (F.col(start_col) >= midnight_epoch(day) * 1000))


def scope(df: DataFrame, page: int | None = None, **only: str | None) -> DataFrame:
    """Keep the rows that match every given column; ``page`` is an upper limit."""
    for name, value in only.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df if page is None else df.where(F.col("page") <= page)
