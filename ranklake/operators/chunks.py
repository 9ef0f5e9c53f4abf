"""Files that close when the bytes written to them reach a threshold, decided over all ranges at once.

Which row closes a file depends on all rows before it in its group. Each range of rows is therefore summed up as
a function: from what the open file holds when the range begins (bytes and rows) to the files that the range closes and
what is open at its end. There is one entry for each row that can be the first to close a file; the rest of the range follows
from that row. Functions of neighbouring ranges are composed, sixteen at a time, until one task can
follow what is carried from block to block; then every block passes it on to its own ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.operators.numbering import laid_out
from ranklake.session import settle

#: Ranges whose functions are composed in one task.
WIDTH = 16
_NO_LIMIT = 1 << 62


@dataclass
class Limits:
    """A file closes with the row that brings it to ``threshold`` bytes or to ``rows`` rows."""

    threshold: int
    rows: int = _NO_LIMIT


def closing_rows(sizes: np.ndarray, limits: Limits, held: int = 0, rows: int = 0) -> np.ndarray:
    """Places of the rows that close a file, where the open file holds ``held`` bytes and ``rows`` rows at first."""
    ends, found, start = np.cumsum(sizes), [], -held
    at = -1 - rows
    while True:
        i = min(int(np.searchsorted(ends, start + limits.threshold)), at + limits.rows)
        if i >= len(ends):
            return np.array(found, np.int64)
        found.append(i)
        start, at = int(ends[i]), i


@dataclass
class Passage:
    """What a range does to the open file: an entry for each row that can be the first to close one.

    ``ends`` are the bytes up to and with the row; ``closed`` the files that the range closes if this row is the first to do
    so; ``held`` and ``rows`` what is open at the end of the range then. ``size`` and ``count`` are those of the whole range.
    """

    ends: np.ndarray
    closed: np.ndarray
    held: np.ndarray
    rows: np.ndarray
    size: int
    count: int

    @classmethod
    def over(cls, sizes: np.ndarray, limits: Limits) -> Passage:
        ends, n = np.cumsum(sizes), len(sizes)
        place = np.arange(n + 1)
        following = np.minimum(np.searchsorted(ends, ends + limits.threshold), np.minimum(place[:n] + limits.rows, n))
        # Chains of closing rows, followed from every row at once by doubling the step.
        last, step, closed = place.copy(), np.append(following, n), np.append(np.ones(n, np.int64), 0)
        while (step < n).any():
            last = np.where(step < n, last[step], last)
            closed = closed + np.where(step < n, closed[step], 0)
            step = step[step]
        first = min(int(np.searchsorted(ends, limits.threshold)), limits.rows - 1, n - 1) + 1 if n else 0
        last = last[:first]
        total = int(ends[-1]) if n else 0
        return cls(ends[:first], closed[:first], total - ends[last], n - 1 - last, total, n)

    def after(self, limits: Limits, held, rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Files closed and what is open after the range, for arrays of what is open before it."""
        held, rows = np.asarray(held, np.int64), np.asarray(rows, np.int64)
        first = np.minimum(np.searchsorted(self.ends, limits.threshold - held), limits.rows - rows - 1)
        # A first closing row is within the entries, or there is none in the range.
        closes = (first < len(self.ends)) & (first < self.count)
        at = np.where(closes, first, 0)
        some = lambda values: values[at] if len(values) else np.zeros(np.shape(at), np.int64)
        return (
            np.where(closes, some(self.closed), 0),
            np.where(closes, some(self.held), held + self.size),
            np.where(closes, some(self.rows), rows + self.count),
        )

    def then(self, other: Passage, limits: Limits) -> Passage:
        """This range and ``other`` after it, as one range."""
        closed, held, rows = other.after(limits, self.held, self.rows)
        # Rows of the other range can be the first to close a file only if none of this range must.
        reach = min(int(np.searchsorted(other.ends, limits.threshold - self.size)), limits.rows - self.count - 1) + 1
        more = slice(0, max(0, min(reach, len(other.ends))))
        return Passage(
            np.append(self.ends, self.size + other.ends[more]),
            np.append(self.closed + closed, other.closed[more]),
            np.append(held, other.held[more]),
            np.append(rows, other.rows[more]),
            self.size + other.size,
            self.count + other.count,
        )


_ARRAYS = ("ends", "closed", "held", "rows")
_SUMMARY = (
    "number long, first string, last string, broken boolean, ends array<long>, closed array<long>, held array<long>, rows array<long>, "
    "size long, count long, tail_closed long, tail_held long, tail_rows long"
)
_CARRY = "number long, open_closed long, open_held long, open_rows long"
_KINDS = {"first": pa.string(), "last": pa.string(), "broken": pa.bool_()} | {a: pa.list_(pa.int64()) for a in _ARRAYS}


def _table(rows: list[dict]) -> pa.Table:
    return pa.table({n: pa.array([r[n] for r in rows], _KINDS.get(n, pa.int64())) for n in rows[0]})


def _row(number: int, first: str, last: str, broken: bool, own: Passage, tail: tuple[int, int, int]) -> dict:
    arrays = {name: getattr(own, name) for name in _ARRAYS}
    names = ("tail_closed", "tail_held", "tail_rows")
    row = {"number": number, "first": first, "last": last, "broken": broken, **arrays}
    return row | {"size": own.size, "count": own.count} | dict(zip(names, map(int, tail)))


def _passage(row: dict) -> Passage:
    return Passage(*[np.array(row[a], np.int64) for a in _ARRAYS], row["size"], row["count"])


def _summarised(limits: Limits):
    """One range: its first group as a function, as it may go on from the range before, and what its last group leaves open."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_index")
        sizes = table["_size"].to_numpy().astype(np.int64)
        groups = table["_group"].combine_chunks().dictionary_encode()
        codes = groups.indices.to_numpy()
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        cut = int(starts[1]) if len(starts) > 1 else len(sizes)
        own = Passage.over(sizes[:cut], limits)
        tail = sizes[starts[-1] :]
        closing = closing_rows(tail, limits)
        last = int(closing[-1]) + 1 if len(closing) else 0
        left = (len(closing), int(tail[last:].sum()), len(tail) - last)
        names = groups.dictionary
        return _table([_row(table["_number"][0].as_py(), names[int(codes[0])].as_py(), names[int(codes[-1])].as_py(), len(starts) > 1, own, left)])

    return run


def _composed(limits: Limits):
    """Neighbouring ranges as one."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("number").to_pylist()
        head = rows[0]
        own, broken, tail = _passage(head), head["broken"], (head["tail_closed"], head["tail_held"], head["tail_rows"])
        last = head["last"]
        for row in rows[1:]:
            joined = row["first"] == last
            if joined and not broken:
                own = own.then(_passage(row), limits)
            if row["broken"]:
                tail = (row["tail_closed"], row["tail_held"], row["tail_rows"])
            else:
                closed, held, count = tail if joined else (0, 0, 0)
                more, held, count = map(int, _passage(row).after(limits, held, count))
                tail = ((closed if joined else 0) + more, held, count)
            broken, last = broken or row["broken"] or not joined, row["last"]
        return _table([_row(head["block"], head["first"], last, broken, own, tail)])

    return run


def _carried(limits: Limits):
    """What each range of a block finds open, from what the block finds open."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("number").to_pylist()
        closed, held, count = rows[0]["open_closed"], rows[0]["open_held"], rows[0]["open_rows"]
        last, out = rows[0]["first"], []
        for row in rows:
            if row["first"] != last:
                closed, held, count = 0, 0, 0
            out.append(dict(zip(("number", "open_closed", "open_held", "open_rows"), (row["number"], closed, held, count))))
            if row["broken"]:
                closed, held, count = row["tail_closed"], row["tail_held"], row["tail_rows"]
            else:
                more, held, count = map(int, _passage(row).after(limits, held, count))
                closed += more
            last = row["last"]
        return _table(out)

    return run


def carried(summaries: DataFrame, limits: Limits) -> DataFrame:
    """For the ``number`` of each range the files its first group has closed before, and what the open one holds."""
    blocked = summaries.withColumn("block", F.floor(F.col("number") / WIDTH))
    if summaries.agg(F.max("number")).first()[0] < WIDTH:
        # Nothing is open before the first range.
        opened = blocked.withColumns({c: F.lit(0).cast("long") for c in ("open_closed", "open_held", "open_rows")})
    else:
        blocks = settle(blocked.groupBy("block").applyInArrow(_composed(limits), _SUMMARY), "chunk-blocks")
        above = carried(blocks, limits).withColumnRenamed("number", "block")
        opened = blocked.join(above, "block")
    return settle(opened.groupBy("block").applyInArrow(_carried(limits), _CARRY), "chunk-carry")


def _closings(limits: Limits):
    """For each group of a range, the files that it has closed before, and the places of the rows that close more."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_index")
        index, sizes = table["_index"].to_numpy(), table["_size"].to_numpy().astype(np.int64)
        groups = table["_group"].combine_chunks().dictionary_encode()
        starts = np.flatnonzero(np.diff(groups.indices.to_numpy(), prepend=-1))
        out = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)]):
            open_ = [table[c][0].as_py() if start == 0 else 0 for c in ("open_closed", "open_held", "open_rows")]
            closing = closing_rows(sizes[start:end], limits, *open_[1:])
            out.append({"_file": table["_file"][0].as_py(), "_group": table["_group"][start].as_py(), "_closed": open_[0], "_closing": index[start:end][closing]})
        kinds = {"_file": pa.string(), "_group": pa.string(), "_closed": pa.int64(), "_closing": pa.list_(pa.int64())}
        return pa.table({n: pa.array([r[n] for r in out], t) for n, t in kinds.items()})

    return run


def encoded_bytes(df: DataFrame) -> Column:
    """The size of a row: that of its JSON text."""
    return F.octet_length(F.to_json(F.struct(*df.columns)))


def chunk_by_bytes(
    df: DataFrame, by: list[str], order: list[str], threshold: int, size: Column | None = None, rows_per_file: int = 0
) -> DataFrame:
    """Add ``file_no``: the file within the partition ``by`` that each row falls into, in ``order``.

    A file closes with the row that brings its bytes to ``threshold`` or, if given, its rows to ``rows_per_file``, so one
    large row closes its file at once. ``size`` is the bytes of a row, those of its JSON text by default; null is none.
    """
    if threshold < 1 or rows_per_file < 0:
        raise ValueError("threshold must be positive and rows_per_file not negative")
    limits = Limits(threshold, rows_per_file or _NO_LIMIT)
    bytes_ = F.coalesce(encoded_bytes(df) if size is None else size, F.lit(0)).cast("long")
    rows, spans, groups = laid_out(df.withColumn("_size", bytes_), order, by)
    if spans.isEmpty():
        return df.withColumn("file_no", F.lit(0).cast("long"))
    group = F.to_json(F.struct(F.lit("").alias("of"), *groups)).alias("_group")
    # Ranges are numbered without gaps: an empty one leaves no file behind.
    files = spans.groupBy("_file", "_number").agg(F.count("*"))
    files = numbered_files(files.select("_file", "_number"))
    narrow = rows.select("_file", "_index", "_size", group).join(files, "_file")
    summaries = settle(narrow.groupBy("_file").applyInArrow(_summarised(limits), _SUMMARY), "chunk-ranges")
    opened = narrow.join(carried(summaries, limits), F.col("_number") == F.col("number")).drop("number")
    closings = opened.groupBy("_file").applyInArrow(_closings(limits), "_file string, _group string, _closed long, _closing array<long>")
    closings = settle(closings, "chunk-closings")
    told = rows.withColumn("_group", group).join(closings, ["_file", "_group"])
    earlier = F.size(F.filter("_closing", lambda at: at < F.col("_index")))
    return told.select(*df.columns, (F.col("_closed") + earlier).alias("file_no"))


def numbered_files(files: DataFrame) -> DataFrame:
    """Files with the place of each among all: one row per range, so one task."""
    place = F.row_number().over(Window.orderBy("_number", "_file")) - 1
    return settle(files.select("_file", place.cast("long").alias("_number")), "chunk-files")
