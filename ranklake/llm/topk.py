"""Exact top-k search without random access.

Every dimension of the candidates is a list sorted by value. A query reads its lists from
the end that gives it most, all to the same depth, and keeps for each candidate a lower and an upper
bound of the score: what has been read, plus the least or the most that the unread lists can
still add. It stops as soon as only few candidates have an upper bound that reaches the k-th best lower
bound; nobody else can qualify. The scores of those few are then resolved from the vectors.

Candidates are held in blocks of bounded size and so are the queries; each pair of blocks is one piece of work
with lists of its own, and the best k of all blocks are ranked at the end. Reading and bounds of all
queries of a block go on together as matrix products, so a step costs the same for each depth read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.session import settle

BLOCK, QUERIES = 4096, 512
#: Share of each list read before the bounds are compared. At the last all bounds are scores.
DEPTHS = (0.25, 0.5, 0.75, 1.0)
#: A query stops reading when at most so many times k candidates can still qualify.
FEW = 16


def integer_vectors(rows: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``id, dim, v``: ``floor(256 * x)`` of each component; unusable vectors left out.

    A null id takes no part; each row of a repeated id does. A vector whose scores could pass 64 bits is an error.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col(row_id).isNotNull() & F.col(vector).isNotNull()).where(finite)
    most = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(vector), F.lit(1)))
    large = F.raise_error(F.lit(f"a component of {vector} is too large for scores of 64 bits")).cast("long")
    whole = F.transform(values, lambda x: F.when(F.abs(x * 256) < most, F.floor(x * 256).cast("long")).otherwise(large))
    return usable.select(F.col(row_id).cast("long").alias("id"), F.size(vector).alias("dim"), whole.alias("v"))


_PACKED = "dim int, ids binary, vectors binary"


def _pack(size: int):
    """Rows to blocks: up to ``size`` rows of one dimension, as bytes of 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            rows = held.pop(dim)
            ids = np.array([r[0] for r in rows], "<i8").tobytes()
            data = np.concatenate([r[1] for r in rows]).astype("<i8").tobytes() if dim else b""
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": [ids], "vectors": [data]})

        for batch in batches:
            flat = batch["v"]
            offsets, values = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False)
            for i, (row, dim) in enumerate(zip(batch["id"].to_numpy(), batch["dim"].to_numpy())):
                held.setdefault(dim, []).append((row, values[offsets[i] : offsets[i + 1]].copy()))
                if len(held[dim]) == size:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    return run


def nra(queries: np.ndarray, rows: np.ndarray, k: int, own: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """For each query the candidates that can be among its best k: few, and none missing.

    ``rows`` are the candidates in rows; ``own`` has pairs of a query and a row that takes no part for it.
    """
    n, dims = rows.shape
    x = rows.astype(np.float64)
    order = np.argsort(rows, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    lists = np.take_along_axis(x, order, axis=0)
    low, high = lists[0], lists[-1]
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    # No sum of the bounds is off by more than this, so no bound excludes by rounding.
    slack = 4 * np.finfo(float).eps * dims * (np.abs(queries).astype(float) @ np.abs(x).max(axis=0))
    found: list = [None] * len(queries)
    going = np.arange(len(queries))
    for depth in DEPTHS:
        read = min(n, int(np.ceil(depth * n)))
        q_up, q_down = up[going], down[going]
        seen_up, seen_down = place >= n - read, place < read
        front_up, front_down = lists[n - read], lists[read - 1]
        # What a list gives to a candidate: its value if read, else at most the front and at least the end.
        most = q_up @ np.where(seen_up, x, front_up).T + q_down @ np.where(seen_down, x, front_down).T
        least = most if read == n else q_up @ np.where(seen_up, x, low).T + q_down @ np.where(seen_down, x, high).T
        at = np.full(len(queries), -1)
        at[going] = np.arange(len(going))
        mine, apart = at[own[0]][at[own[0]] >= 0], own[1][at[own[0]] >= 0]
        most[mine, apart] = -np.inf
        if least is not most:
            least[mine, apart] = -np.inf
        kth = np.partition(least, n - k, axis=1)[:, n - k] if n > k else np.full(len(going), -np.inf)
        able = most >= (kth - slack[going])[:, None]
        if read == n:  # bounds are scores: only ties and rounding leave more than k
            done = np.ones(len(going), bool)
        else:
            done = able.sum(axis=1) <= FEW * k
        for i in np.flatnonzero(done):
            found[going[i]] = np.flatnonzero(able[i])
        going = going[~done]
        if not len(going):
            break
    return found


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                ids, qids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                data = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), dim)
                asked = np.frombuffer(row["q_vectors"], "<i8").reshape(len(qids), dim)
                by_id = np.argsort(ids)
                first = np.searchsorted(ids[by_id], qids)
                same = np.searchsorted(ids[by_id], qids, "right") - first
                asking = np.repeat(np.arange(len(qids)), same)
                apart = by_id[np.repeat(first - (np.cumsum(same) - same), same) + np.arange(same.sum())]
                out: list = [[], [], []]
                for q, able in enumerate(nra(asked, data, k, (asking, apart))):
                    able = able[ids[able] != qids[q]]
                    scores = data[able] @ asked[q]
                    best = np.lexsort((ids[able], -scores))[:k]
                    out[0].append(np.full(len(best), qids[q]))
                    out[1].append(ids[able][best])
                    out[2].append(scores[best])
                cols = [pa.array(np.concatenate(c), pa.int64()) for c in out]
                yield pa.RecordBatch.from_arrays(cols, names=["query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row for which ``is_query`` holds.

    ``is_query`` is a condition on ``id``. The score is the inner product of the integer vectors, in
    64 bits; vectors of another length than the query's take no part. Ties go to the smaller id. A query
    with fewer candidates gets all of them. Each row of a repeated id is a candidate; those that share a query's id are its own
    and no candidates, and together they get the best of all they ask. Empty tables give no rows; other columns are ignored.
    """
    vectors = settle(integer_vectors(rows, row_id, vector), "topk-vectors")
    queries = vectors.where(is_query)
    parts = F.ceil(F.count("*") / QUERIES).cast("int")
    counts = settle(queries.groupBy("dim").agg(parts.alias("_parts")), "topk-parts")  # a row per vector length
    blocks = vectors.select("id", "dim", "v").mapInArrow(_pack(BLOCK), _PACKED)
    dealt = queries.join(counts, "dim").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    packed = (
        dealt.groupBy("dim", "_part")
        .agg(F.collect_list(F.struct("id", "v")).alias("_rows"))
        .mapInArrow(_to_bytes, "dim int, _part int, q_ids binary, q_vectors binary")
    )
    asked = blocks.join(counts, "dim").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    pairs = asked.join(settle(packed, "topk-queries"), ["dim", "_part"]).select("dim", "ids", "vectors", "q_ids", "q_vectors")
    pairs = pairs.repartition(F.xxhash64("ids", "q_ids"))
    best = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([row["dim"]], pa.int32()), "_part": pa.array([row["_part"]], pa.int32()),
                "q_ids": [np.array([r["id"] for r in row["_rows"]], "<i8").tobytes()],
                "q_vectors": [np.array([r["v"] for r in row["_rows"]], "<i8").tobytes()],
            })
