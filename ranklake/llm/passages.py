"""Remove passages that occur more than once, exactly, by suffix order of what can repeat.

A string of ``LENGTH`` bytes is named by its anchor, the ``GRAM`` bytes in it with the smallest hash.
Equal strings have equal anchors, so strings with an anchor that occurs once cannot repeat. Strings that start
side by side mostly share their anchor; such a run of them is kept as one stretch of bytes.

1. Anchors of all texts are counted. Those that occur again are marked in a bit table of fixed size, which
   decides only what is looked at further, never what is removed.
2. Stretches whose anchor is marked are gathered by anchor; equal ones count as one, already before the shuffle.
3. The bytes of an anchor's stretches are put in suffix order by the difference-cover algorithm
   (``suffixes``): triples of sampled places are sorted and named, the string of names is ordered again, the
   remaining suffixes are merged, and neighbours that share a prefix mark strings that occur again. Its
   symbols are blocks of four bytes that lie alike around the anchor, as equal strings do.
   An anchor with more stretches than one task should hold is settled by a count of its strings, spread over all tasks.
4. The marked strings go back to their texts, where what they cover is cut out.

Rows are joined by the digest of their text: what is removed from a text depends on nothing else. Texts are
read three times, as their stretches would fill several times the room of the texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.llm.common import dense_table, partitions, present
from ranklake.llm.suffixes import LIMIT, order_places
from ranklake.session import settle

LENGTH, GRAM = 200, 32
_WINDOW = LENGTH - GRAM + 1
_PIECE = 1 << 20
#: Bits of the table of anchors that occur again: 2^28 is 32 MB, whatever the number of texts.
TABLE_LOG = 28
#: Bytes of a block, and how many whole blocks a string holds wherever it starts.
BLOCK = 4
INNER = LENGTH // BLOCK - 1
#: Bytes of stretches that are ordered at once, and of one anchor before its strings are counted instead.
BATCH, MOST = 1 << 20, LIMIT
#: Stretches, or bytes of texts, that a task holds before it hands them on.
_HELD, _HELD_BYTES = 50_000, 16 << 20
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def _hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes that start at each place."""
    n = len(data) - GRAM + 1
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    mixed = np.zeros(n, np.uint64)
    for i, factor in enumerate(_MIX):
        mixed ^= words[8 * i : 8 * i + n]
        mixed *= np.uint64(factor)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def stretches(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of string starts that share their anchor: its hash, the first start, the number of starts, the anchor's place."""
    for at in range(0, len(text) - LENGTH + 1, _PIECE):
        data = np.frombuffer(text[at : at + _PIECE + LENGTH - 1], np.uint8)
        hashed = _hashes(data)
        # The hash, then the place: of equal hashes the leftmost is the anchor.
        least = hashed & np.uint64(0xFFFFFFFFFF000000) | np.arange(len(hashed), dtype=np.uint64)
        reach = 1
        while 2 * reach <= _WINDOW:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        least = np.minimum(least[: len(least) - (_WINDOW - reach)], least[_WINDOW - reach :]) if reach < _WINDOW else least
        starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        places = (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        yield hashed[places].view(np.int64), starts + at, np.diff(np.r_[starts, len(least)]), places + at


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [a for t in batch["text"] for a, *_ in stretches(t.as_py())]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["anchor"])


def _table(anchors: DataFrame) -> np.ndarray:
    """The bit table of anchors that occur again: ``2 ** TABLE_LOG`` bits, whatever their number."""
    again = anchors.groupBy("anchor").count().where("count > 1")
    place = F.shiftrightunsigned("anchor", 64 - TABLE_LOG)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - TABLE_LOG}) & 63 as int))")
    words = again.groupBy(F.shiftright(place, 6).alias("place")).agg(F.bit_or(bit).alias("value"))
    return dense_table(words, TABLE_LOG - 6, "i8").view(np.uint64)


def _marked(table: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    place = anchors.view(np.uint64) >> np.uint64(64 - TABLE_LOG)
    return table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) == 1


def _marked_stretches(text: bytes, table: np.ndarray) -> Iterator[tuple[int, int, bytes, int]]:
    """Of the stretches whose anchor is marked: anchor, first start, bytes, and where in them the anchor is."""
    for anchors, starts, sizes, places in stretches(text):
        use = _marked(table, anchors)
        for anchor, start, size, place in zip(*(x[use].tolist() for x in (anchors, starts, sizes, places))):
            yield anchor, start, text[start : start + size + LENGTH - 1], place - start


def _digest(stretch: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(stretch)).view(np.int64))


def _contents(table):
    """Stretches and how often each occurs in some of the texts."""

    def counted(found: Counter) -> pa.RecordBatch:
        anchors, stretch, at = zip(*found)
        columns = [pa.array(anchors), pa.array(map(_digest, stretch)), pa.array(at), pa.array(found.values()), pa.array(stretch, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "digest", "at", "n", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update((a, b, at) for a, _, b, at in _marked_stretches(text.as_py(), table.value))
                if len(found) > _HELD:
                    yield counted(found)
                    found.clear()
        if found:
            yield counted(found)

    return run


def _places(table):
    """Where stretches are, each text of the batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (key, start, anchor, _digest(stretch))
                for key, text in dict(zip(batch["key"].to_pylist(), batch["text"])).items()
                for anchor, start, stretch, _ in _marked_stretches(text.as_py(), table.value)
            ]
            if rows:
                types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "anchor", "digest"])

    return run


def repeated_starts(stretch_bytes: list[bytes], at: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """For each distinct stretch whether each string that starts in it occurs again, in a stretch or by count.

    ``at`` is where the anchor lies. Equal strings lie alike around their anchors, so they are cut alike into blocks:
    a string is the whole blocks in it and the bytes at both ends, ``BLOCK`` of them in all.
    """
    sizes = np.array([len(b) for b in stretch_bytes])
    before = (-at) % BLOCK  # room before a stretch, so that its anchor starts a block
    room = -(-(before + sizes) // BLOCK) * BLOCK
    firsts = np.cumsum(room) - room + before
    data = np.zeros(int(room.sum()) + 8, np.uint8)
    inside = np.repeat(firsts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    data[inside] = np.frombuffer(b"".join(stretch_bytes), np.uint8)
    blocks = data[:-8].view("<u4")
    own = np.zeros(len(data) - 8, bool)
    own[inside] = True
    whole = own.reshape(-1, BLOCK).all(axis=1)
    # Blocks at the ends get symbols of their own, so that no two suffixes agree across an end.
    symbols = np.empty(len(blocks), np.int64)
    kinds, symbols[whole] = np.unique(blocks[whole], return_inverse=True)
    symbols[~whole] = len(kinds) + np.arange(int((~whole).sum()))
    last = np.repeat((firsts + sizes) // BLOCK, room // BLOCK)
    holds = whole & (np.arange(len(blocks)) + INNER <= last)
    # Where a stretch ends its last block may be cut: a separator stands between all stretches.
    gap = np.repeat(np.arange(len(sizes)), room // BLOCK)
    spread = np.zeros(len(blocks) + len(sizes), np.int64)
    slot = np.arange(len(blocks)) + gap
    spread[slot] = symbols + 1
    ends = np.cumsum(room // BLOCK) + np.arange(len(sizes))
    spread[ends] = symbols.max() + 2 + np.arange(len(sizes))
    order = np.argsort(order_places(spread, INNER)[slot], kind="stable")
    order = order[holds[order]]
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    new = np.zeros(len(order), bool)
    for step in (*range(0, INNER * BLOCK - 7, 8), INNER * BLOCK - 8):
        value = words[order * BLOCK + step]
        new[1:] |= value[1:] != value[:-1]
    kind = np.zeros(len(blocks) + 1, np.int64)
    kind[order] = np.cumsum(new)

    starts = sizes - LENGTH + 1
    place = np.repeat(firsts - np.cumsum(starts) + starts, starts) + np.arange(starts.sum())
    block = -(-place // BLOCK)
    left = (BLOCK * block - place) * 8  # bits before the first whole block; the rest of four bytes follow the last
    head = words[place] & ((np.uint64(1) << left.astype(np.uint64)) - np.uint64(1))
    tail = words[(block + INNER) * BLOCK] & ((np.uint64(1) << (8 * BLOCK - left).astype(np.uint64)) - np.uint64(1))
    rim = (head | tail << left.astype(np.uint64)).astype(np.int64)
    key = (kind[block] << 2 | left // 8) << 8 * BLOCK | rim
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    again = np.split(times[inverse] > 1, np.cumsum(starts)[:-1])
    return [np.ones(len(flags), bool) if n > 1 else flags for flags, n in zip(again, counts)]


def _spans(flags: np.ndarray) -> list[int]:
    """First and one past last of each run of set flags, in turn."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edges.tolist()


_STRETCH = "anchor long, digest long, at long, n long, bytes binary"
_JUDGED = "anchor long, digest long, spans array<int>, n long, bytes binary"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches in order of anchor and digest. Gives spans, or hands on the bytes where an anchor has too many."""
    out: list[list] = [[], [], [], [], []]
    batch_rows: list[list] = []
    size = 0

    def emit() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.binary())
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["anchor", "digest", "spans", "n", "bytes"])
        for c in out:
            c.clear()
        return done

    def add(row: list, spans: list[int] | None) -> None:
        anchor, digest, _, n, stretch = row
        for c, v in zip(out, (anchor, digest, spans, n, None if spans is not None else stretch)):
            c.append(v)

    def settle_batch() -> None:
        nonlocal size
        if batch_rows:
            _, _, at, n, stretch = zip(*batch_rows)
            flags = repeated_starts(list(stretch), np.array(at), np.array(n))
            for row, own in zip(batch_rows, flags):
                if own.any():
                    add(row, _spans(own))
        batch_rows.clear()
        size = 0

    group: list[list] = []
    held = 0
    passed: int | None = None  # the anchor whose rows are handed on

    def close() -> None:
        nonlocal group, held, size
        if len(group) == 1 and group[0][3] > 1:
            add(group[0], [0, len(group[0][4]) - LENGTH + 1])
        elif len(group) > 1:
            if size + held > max(BATCH, held):
                settle_batch()
            batch_rows.extend(group)
            size += held
        group, held = [], 0

    for batch in batches:
        for row in map(list, zip(*(batch[c].to_pylist() for c in ("anchor", "digest", "at", "n", "bytes")))):
            if group and group[0][0] != row[0]:
                close()
            if passed == row[0]:
                add(row, None)
            elif group and group[-1][1] == row[1]:
                group[-1][3] += row[3]  # the same stretch from another batch
            else:
                group.append(row)
                held += len(row[4]) + BLOCK
                if held > MOST:
                    passed = row[0]
                    for r in group:
                        add(r, None)
                    group, held = [], 0
            if len(out[0]) > 2000:
                yield emit()
    close()
    settle_batch()
    yield emit()


def _counted_strings(rows: DataFrame) -> DataFrame:
    """Spans of stretches whose anchor is too common for one task: each string is counted by itself."""
    starts = F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)
    string = F.substring(F.col("bytes"), F.col("at") + 1, F.lit(LENGTH))
    each = rows.withColumn("at", F.explode(starts)).withColumn("string", string)
    again = each.groupBy("string").agg(F.sum("n").alias("times")).where("times > 1").select("string")
    hit = each.join(again, "string", "left_semi").groupBy("anchor", "digest").agg(F.collect_set("at").alias("at"))
    one = F.transform("at", lambda x: F.array(x, x + 1))
    return hit.select("anchor", "digest", F.flatten(one).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[list] = [[], [], [], [], []]

    def emit() -> pa.RecordBatch:
        digests = pa.array([hashlib.sha256(k).hexdigest() for k in out[4]])
        arrays = [*(pa.array(c, pa.int64()) for c in out[:4]), digests, pa.array(out[4], pa.binary())]
        done = pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        for c in out:
            c.clear()
        return done

    for batch in batches:
        held = 0
        for row, text, found in zip(batch["id"].to_pylist(), batch["text"], batch["found"]):
            text, found = text.as_py(), found.as_py()
            edge = np.zeros(len(text) + 1, np.int32)
            for part in found or ():
                for a, b in zip(part["spans"][::2], part["spans"][1::2]):
                    edge[part["start"] + a] += 1
                    edge[part["start"] + b - 1 + LENGTH] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for c, v in zip(out, (row, len(text), int(gone.sum()), len(_spans(gone)) // 2, kept)):
                c.append(v)
            held += len(kept)
            if held > _HELD_BYTES:
                yield emit()
                held = 0
        if out[0]:
            yield emit()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    Bytes of the whole UTF-8 text go that lie in a string of ``LENGTH`` bytes that also starts elsewhere, in the same
    row or another; all copies go, and strings are judged on the input. ``kept`` is what remains, as bytes: a cut may
    fall within a character. Null text is empty. Repeated rows are copies of each other. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    data = present(text).cast("binary")
    key = F.unhex(F.substring(F.sha2(data, 256), 1, 32))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), key.alias("key"), data.alias("text"))
    long = texts.where(F.octet_length("text") >= LENGTH)
    table = spark.sparkContext.broadcast(_table(long.select("text").mapInArrow(_anchors, "anchor long")))
    found = long.select("text").mapInArrow(_contents(table), _STRETCH)
    sorted_rows = found.repartition(partitions(docs), "anchor").sortWithinPartitions("anchor", "digest")
    judged = settle(sorted_rows.mapInArrow(_judge, _JUDGED), "passages-judged")
    spans = judged.where("spans is not null").select("anchor", "digest", "spans")
    spans = spans.unionByName(_counted_strings(judged.where("spans is null")))

    places = long.select("key", "text").mapInArrow(_places(table), "key binary, start long, anchor long, digest long")
    found = places.join(spans, ["anchor", "digest"]).groupBy("key").agg(F.collect_set(F.struct("start", "spans")).alias("found"))
    cut = texts.join(settle(found, "passages-found"), "key", "left").select("id", "text", "found")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return cut.mapInArrow(_cut, schema)
