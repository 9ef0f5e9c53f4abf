"""Calendar arithmetic in UTC, whatever the time zone of the session."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY_MS = 86_400_000


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(value: date | str | Column) -> Column:
    """A run date given as a date, an ISO text or a column."""
    if isinstance(value, Column):
        return value
    return F.lit(date.fromisoformat(value) if isinstance(value, str) else value)


def as_timestamp(value: datetime | str | Column) -> Column:
    """A run time given as a datetime (UTC where it has no zone), an ISO text or a column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return F.lit(value if value.tzinfo else value.replace(tzinfo=UTC))


def utc_date(millis: str | Column) -> Column:
    """Date of an epoch-millisecond value. A negative value is an error."""
    ms = _col(millis)
    day = F.date_from_unix_date(F.floor(ms / F.lit(_DAY_MS)).cast("int"))
    return F.when(ms < 0, F.raise_error(F.lit("start time must not be negative"))).otherwise(day)


def with_partition_date(df: DataFrame, millis: str) -> DataFrame:
    """Add ``year``, ``month`` and ``date`` (day of month) of an epoch-millisecond column."""
    day = utc_date(millis)
    return df.withColumns({"year": F.year(day), "month": F.month(day), "date": F.dayofmonth(day)})


def midnight_epoch(day: str | Column) -> Column:
    """Epoch seconds at 00:00 UTC of a date."""
    return F.unix_date(_col(day)).cast("long") * 86_400


def ntz_millis(ts: str | Column) -> Column:
    """Epoch milliseconds of a timestamp without zone, read as UTC."""
    t = _col(ts)
    day = F.unix_date(t.cast("date")).cast("long") * _DAY_MS
    within = F.hour(t) * 3_600_000 + F.minute(t) * 60_000
    return day + within + F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")


def parse_date(col: str | Column, kind: str) -> Column:
    """A stored read date, in any form it has been stored in, as a date.

    NULL and NaN give NULL. Text that is no date is an error.
    """
    c = _col(col)
    if kind in ("text", "date", "timestamp_ntz"):
        return c.cast("date")
    if kind == "timestamp":
        return F.date_from_unix_date(F.floor(F.unix_micros(c) / F.lit(_DAY_MS * 1000)).cast("int"))
    number = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if kind == "epoch_seconds":
        return F.date_from_unix_date(F.floor(number / 86_400).cast("int"))
    if kind == "epoch_days":
        return F.date_from_unix_date(number.cast("int"))
    raise ValueError(f"unknown kind of date: {kind}")
