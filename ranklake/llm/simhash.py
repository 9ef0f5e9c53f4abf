"""SimHash near-duplicates, linked with Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments. If two differ in at most three bits, then either
one segment is the same and one of the others differs in at most one bit, or each of the three
differs in exactly one. Where a segment may differ in a bit, it is decoded to the indices of
nearby codewords (``golay``), which both sides share. So a pair meets under one of these keys:

* the bits of one segment and a codeword index of another (six ways), or
* a codeword index of the first segment and an equal half of each of the others (four ways).

Rows are distinct fingerprints, so exact copies are one row. Rows of a key come together in one sorted run,
are compared there bit by bit, and leave only links that hold; a long run leaves the links of a spanning
forest. Components of the links are found by star contraction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklake.llm import golay
from ranklake.llm.common import first_of, key_of, present, unused
from ranklake.llm.components import components
from ranklake.session import settle

SEED, SHINGLE = 42, 3
BITS = 3
#: First bit and length of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
_LONG, _PIECE = 64, 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in bounded lists; the last words of each list start the next one."""
    at, carried = 0, []
    while at < len(text):
        cut = _SPACE.search(text, min(len(text), at + _PIECE))
        end = cut.start() if cut else len(text)
        words = carried + text[at:end].lower().split()
        at = end
        if len(words) >= SHINGLE or at >= len(text):
            yield words
            carried = words[-(SHINGLE - 1) :]
        else:
            carried = words


def fingerprint(text: bytes) -> int:
    """The SimHash of a whole text in UTF-8, unsigned: zero if it has no words."""
    ones, total = np.zeros(64, np.int64), 0
    first = True
    for words in _pieces(text):
        if len(words) < SHINGLE:
            if not (first and words):
                continue
            shingles = [b" ".join(words)]
        else:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
        first = False
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch["text"]], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["row"], batch["id"], pa.array(found)], names=["row", "id", "fp"])


def key_rows(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which fingerprints meet, and for each the place of its fingerprint."""
    words = fps.view(np.uint64)
    parts = [(words >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    codes = [golay.keys(p) for p in parts]
    out = []
    tag = 0
    for same in range(3):
        for near in range(3):
            if near != same:
                out.append((tag, parts[same], codes[near]))
                tag += 1
    halves = [(p & 0x7FF, p >> 11) for p in parts]
    for second in halves[1]:
        for third in halves[2]:
            out.append((tag, second << 11 | third, codes[0]))
            tag += 1
    place = np.arange(len(fps))
    keys, places = [], []
    for tag, exact, code in out:
        used = code >= 0
        keys.append((np.int64(tag) << 40 | exact[:, None] << 12 | code)[used])
        places.append(np.broadcast_to(place[:, None], code.shape)[used])
    return np.concatenate(keys), np.concatenate(places)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch["fp"].to_numpy()
        keys, places = key_rows(fps)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[places])], names=["key", "fp"])


def forest(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of ``fps`` that chains of close pairs join: one fewer than there are in each component.

    Each fingerprint is compared with those that no link has reached yet, so a dense run takes few steps.
    """
    rest = np.unique(fps)
    left, right = [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            close = np.bitwise_count((rest ^ at).view(np.uint64)) <= bits
            reached = rest[close]
            left.append(np.full(len(reached), at))
            right.append(reached)
            queue.extend(reached)
            rest = rest[~close]
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def close_pairs(keys: np.ndarray, fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of a key. ``keys`` are sorted and no key goes on outside."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    left, right = [], []
    for s, n in zip(starts[sizes > _LONG], sizes[sizes > _LONG]):
        a, b = forest(fps[s : s + n], bits)
        left.append(a)
        right.append(b)
    short = np.repeat((sizes > 1) & (sizes <= _LONG), sizes)
    keys, fps = keys[short], fps[short]
    for step in range(1, min(_LONG, len(keys))):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(same):
            break
        a, b = fps[same], fps[same + step]
        close = (a != b) & (np.bitwise_count((a ^ b).view(np.uint64)) <= bits)
        left.append(a[close])
        right.append(b[close])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = close_pairs(keys, fps)
        pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1) if len(a) else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy()
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
        if whole or (held and held[-1][0][-1] != keys[0]):
            held.append((keys[:whole], fps[:whole]))
            yield links(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held = []
        held.append((keys[whole:], fps[whole:]))
    if held:
        yield links(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))


def near_links(fingerprints: DataFrame) -> DataFrame:
    """``a, b``: links that join all values of ``fp``, which are distinct, that differ in at most ``BITS`` bits; a > b."""
    keyed = fingerprints.select("fp").mapInArrow(_keyed, "key long, fp long")
    runs = keyed.repartition("key").sortWithinPartitions("key")
    return runs.mapInArrow(_linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id`` (and ``row``, a column that identifies rows).

    ``component_id`` is the smallest id that links of at most three bits reach. Null text has no
    words and the fingerprint zero. Rows with a null id get a component like others, but name none. Repeated
    rows stay. An empty table gives no rows. Other columns are ignored.
    """
    shaped = docs.select(
        (F.col(row) if row else F.lit(0)).cast("long").alias("row"),
        F.col(doc_id).cast("long").alias("id"),
        present(text).cast("binary").alias("text"),
    )
    prints = settle(shaped.mapInArrow(_fingerprints, "row long, id long, fp long"), "simhash-prints")
    firsts = settle(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-firsts")
    linked = components(near_links(firsts), "fp", "root")
    rooted = firsts.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(rooted.join(least, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        *([F.col("row").alias(row)] if row else []),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays: that with the smallest id, one of them if they share it. Same columns."""
    own, body = unused(docs, "id", "text")
    named = docs.withColumns({own: key_of(F.col(doc_id)), body: F.xxhash64(present(text))})
    marked = near_duplicates(named, doc_id, text, body).withColumnRenamed(body, "_text")
    # A row stays if its id is its component's. A component without ids keeps a row for each fingerprint.
    able = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    group = ["doc_id", F.when(F.col("doc_id").isNull(), F.col("fingerprint"))]
    order = Window.partitionBy(*group).orderBy("_text")
    stay = able.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    stay = settle(stay.select(key_of(F.col("doc_id")).alias(own), F.col("_text").alias(body)), "simhash-stay")
    return first_of(named.join(stay, [own, body], "left_semi"), [own, body]).select(*docs.columns)
