"""Pack documents into token sequences of fixed length, as a cutting-stock problem.

A document is cut into full sequences and a remainder. The histogram of remainders, one count for each length
below the capacity, is all that the plan needs: column generation (``cutting``) gives patterns and
how often each is used. Every place in a pattern is then owed to a run of ranks: documents are ranked
among those of the same remainder, and rank decides sequence and offset. Ranks come from
``numbered``, which puts no group into one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.llm import cutting, tokens
from ranklake.llm.common import present
from ranklake.operators.numbering import numbered
from ranklake.session import settle

CAPACITY = 1024
END_ID = 0


def _counted(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums = [], []
            for text in batch["text"]:
                ids = tokens.token_bytes(text.as_py(), path) + END_ID.to_bytes(4, "little")
                sizes.append(len(ids) // 4)
                sums.append([zlib.crc32(ids[i : i + 4 * capacity]) for i in range(0, len(ids), 4 * capacity)])
            arrays = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "tokens", "sums"])

    return run


def places(uses: list[cutting.Use]) -> dict[str, np.ndarray]:
    """For each length the runs of ranks that share a place: arrays in order of length and rank."""
    rows, taken, sequence = [], {}, 0
    for use in uses:
        offset = 0
        for length in use.lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset))
            taken[length] = rank + use.times
            offset += length
        sequence += use.times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T))


def _planned(capacity: int):
    """The plan for a histogram that arrives as one row: bounded by the capacity, and kept off the driver's threads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                demand = np.zeros(capacity + 1, np.int64)
                for one in row["lengths"]:
                    demand[one["rest"]] = one["n"]
                plan = places(cutting.solve(demand))
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in plan.items()})

    return run


def _placed(plan: dict[str, np.ndarray], starts: np.ndarray, sequences: int, fulls: int, capacity: int):
    """``starts``: the number of documents with a shorter remainder, which makes ranks unique over all."""
    begin = starts[plan["length"]] + plan["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch["tokens"].to_numpy()
            lists = batch["sums"]
            size = total % capacity
            number = starts[size] + batch["rank"].to_numpy()
            full, pieces = total // capacity, lists.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            rest = piece == full[doc]
            sequence = sequences + number[doc] * fulls + piece
            offset = np.zeros(len(doc), np.int64)
            if rest.any():
                own = number[doc[rest]]
                at = np.searchsorted(begin, own, "right") - 1
                sequence[rest] = plan["sequence"][at] + own - begin[at]
                offset[rest] = plan["offset"][at]
            columns = {
                "doc_id": batch["doc_id"].take(pa.array(doc)), "start": piece * capacity,
                "length": np.where(rest, size[doc], capacity), "ids_crc32": lists.flatten(),
                "doc_tokens": total[doc], "sequence_id": sequence, "offset": offset,
            }
            yield pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in columns.items()})

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``vocabulary`` is the path of a byte-level BPE file on every executor. Each document is its
    ids and one end id; each id lies in one piece, each sequence holds at most ``capacity`` ids,
    pieces follow each other without gaps, and only what patterns leave open is padding.
    Sequence ids are unique but have gaps.

    Null and empty texts are one end id. Rows that repeat an id are packed one by one. An empty table gives
    no rows. Other columns are ignored.
    """
    path = vocabulary or tokens.default_vocabulary()
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), present(text).alias("text"))
    counted = texts.mapInArrow(_counted(path, capacity), "doc_id long, tokens long, sums array<long>")
    counted = counted.withColumn("rest", (F.col("tokens") % capacity).cast("int"))
    # The digest orders documents of one id, so that no number of equal keys has to stay together.
    counted = counted.withColumn("tie", F.xxhash64("doc_id", "sums"))
    # Written first: the ranges of the numbering are found in a pass of their own, which would count all tokens again.
    counted = settle(counted, "packing-counts")
    ranked = settle(numbered(counted, ["tie", "doc_id"], ["rest"], "rank"), "packing-ranks")
    lengths = ranked.groupBy("rest").agg(F.count("*").alias("n"), F.max("tokens").alias("most"))
    lengths = settle(lengths, "packing-lengths")  # at most one row per length
    found = lengths.collect()
    counts = np.zeros(capacity, np.int64)
    for row in found:
        counts[row.rest] = row.n
    starts = np.cumsum(counts) - counts
    fulls = max([row.most for row in found], default=0) // capacity + 1
    histogram = lengths.where("rest > 0").agg(F.collect_list(F.struct("rest", "n")).alias("lengths"))
    plan = histogram.mapInArrow(_planned(capacity), "length long, rank long, sequence long, offset long").toPandas()
    plan = {name: plan[name].to_numpy(np.int64) for name in plan}
    sequences = int(plan["sequence"].max() + counts.max()) if len(plan["sequence"]) else 0
    placed = _placed(plan, starts, sequences, fulls, capacity)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.select("doc_id", "tokens", "sums", "rank").mapInArrow(placed, schema)
