"""Token counts of whole texts without their ids: pieces are counted once for each distinct pre-token.

A task cuts its documents into pre-tokens and keeps, for each block of documents, how often each
pre-token stands in each of them. These frequencies are shuffled by pre-token; there the pieces of a pre-token are
counted once and multiplied into all its frequencies. The sums go back to the block, where the documents wait.
A pre-token of many documents is settled inside its block, so that no frequent one is shuffled at all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.llm import tokens
from ranklake.llm.common import partitions, present

LIMIT = 512
#: Documents of a block, pairs of document and piece of text after which a block ends early, and characters likewise.
BLOCK, PAIRS, CHARACTERS = 8192, 1 << 22, 1 << 25
#: A pre-token is settled in its block if it stands in more than this share of the block's documents.
COMMON = 64
#: Pre-tokens whose pieces a worker remembers.
_REMEMBERED = 1_000_000


@cache
def _tokenizer(path: str):
    if not path.endswith(".json"):
        raise ValueError(f"{path}: only .json vocabularies can be counted by pre-token")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _byte_level(path: str) -> bool:
    """Whether pre-tokens are cut by the pattern of byte-level vocabularies, and so before single spaces."""
    said = _tokenizer(path)
    kind = said.pre_tokenizer
    return said.normalizer is None and type(kind).__name__ == "ByteLevel" and not kind.add_prefix_space


class _Pieces(dict):
    """How many tokens a pre-token becomes."""

    def __init__(self, path: str) -> None:
        self.model = _tokenizer(path).model

    def __missing__(self, token: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[token] = found = len(self.model.tokenize(token))
        return found


@cache
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


class _Numbers(dict):
    """Numbers of stretches of text: the place of ``lead`` and the stretch in ``names``."""

    def __init__(self, names: list[str], lead: str) -> None:
        self.names, self.lead = names, lead

    def __missing__(self, stretch: str) -> int:
        self[stretch] = number = len(self.names)
        self.names.append(self.lead + stretch)
        return number


class _Block:
    """Documents whose frequencies are gathered together."""

    def __init__(self, path: str, number: int, id_type: pa.DataType) -> None:
        self.path, self.number, self.id_type = path, number, id_type
        self.names: list[str] = []
        self.first, self.later = _Numbers(self.names, ""), _Numbers(self.names, " ")
        self.ids, self.sizes, self.fixed = [], [], []
        self.stretches, self.times = [], []
        self.pairs = self.characters = 0

    def add(self, doc_id, text: str) -> None:
        parts, marks = tokens.between(text, self.path)
        first, later = Counter(), Counter()
        for part in parts:
            if _byte_level(self.path) and tokens.cuts_at_spaces(part):
                words = part.split(" ")
                first[words[0]] += 1
                later.update(words[1:])
            else:
                first[part] += 1
        for found, numbers in ((first, self.first), (later, self.later)):
            self.stretches.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            self.times.append(np.fromiter(found.values(), np.int64, len(found)))
        self.ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.fixed.append(len(marks))
        self.pairs += len(first) + len(later)
        self.characters += len(text)

    def full(self, most: int = BLOCK) -> bool:
        return len(self.ids) >= most or self.pairs >= PAIRS or self.characters >= CHARACTERS

    def _frequencies(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens, and sorted by pre-token and document: numbers of both, and how often."""
        said = _tokenizer(self.path)
        known: dict[str, int] = {}
        flat, ends = [], []
        for name in self.names:
            text = name if said.normalizer is None else said.normalizer.normalize_str(name)
            flat += [known.setdefault(token, len(known)) for token, _ in said.pre_tokenizer.pre_tokenize_str(text)]
            ends.append(len(flat))
        ends, flat = np.array(ends, np.int64), np.array(flat, np.int64)
        lengths = np.diff(ends, prepend=0)
        doc = np.repeat(np.arange(len(self.stretches)) // 2, [len(x) for x in self.stretches])
        stretch, times = np.concatenate(self.stretches), np.concatenate(self.times)
        each = lengths[stretch]
        own = np.repeat((ends - lengths)[stretch] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        key = flat[own] << 16 | np.repeat(doc, each)
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.repeat(times, each)[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times, new) if len(new) else times
        return list(known), key[new] >> 16, key[new] & 0xFFFF, times

    def close(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """The row of the block itself, and one for each bucket of pre-tokens that is not settled here."""
        names, token, doc, times = self._frequencies()
        pieces = _pieces(self.path)
        common = np.bincount(token, minlength=len(names)) * COMMON > len(self.ids)
        here = np.zeros(len(names), np.int64)
        for i in np.flatnonzero(common).tolist():
            here[i] = pieces[names[i]]
        sums = np.array(self.fixed, np.int64)
        settled = common[token]
        np.add.at(sums, doc[settled], here[token[settled]] * times[settled])
        yield self._row(bucket=-1, ids=self.ids, sizes=self.sizes, counts=sums.tolist())

        left = ~settled
        token, doc, times = token[left], doc[left], times[left]
        # Times fit a byte: what is more becomes several entries.
        copies = -(-times // 255)
        rest = times - 255 * (copies - 1)
        token, doc, times = np.repeat(token, copies), np.repeat(doc, copies), np.full(copies.sum(), 255)
        times[np.cumsum(copies) - 1] = rest
        bucket = np.array([zlib.crc32(n.encode()) % buckets for n in names], np.int64)
        order = np.argsort(bucket[token], kind="stable")
        token, doc, times = token[order], doc[order].astype("<u2"), times[order].astype("u1")
        edges = np.flatnonzero(np.diff(bucket[token], prepend=-1, append=-1))
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = token[start:end]
            runs = np.flatnonzero(np.diff(own, prepend=-1))
            yield self._row(
                bucket=int(bucket[own[0]]),
                names=[names[i] for i in own[runs].tolist()],
                runs=np.diff(runs, append=end - start).astype("<u4").tobytes(),
                docs=doc[start:end].tobytes(),
                times=times[start:end].tobytes(),
            )

    def _row(self, **values) -> pa.RecordBatch:
        row = {"block": self.number, **values}
        return pa.RecordBatch.from_pydict({f.name: pa.array([row.get(f.name)], f.type) for f in _frequency_schema(self.id_type)})


def _frequency_schema(id_type: pa.DataType) -> pa.Schema:
    """A block (``ids``, ``sizes`` and ``counts`` so far) or, of a bucket of pre-tokens, where in a block they stand.

    ``runs`` has the number of entries of each name, ``docs`` and ``times`` the entries.
    """
    return pa.schema(
        {
            "bucket": pa.int64(), "block": pa.int64(), "ids": pa.list_(id_type), "sizes": pa.list_(pa.int64()),
            "counts": pa.list_(pa.int64()), "names": pa.list_(pa.string()), "runs": pa.binary(), "docs": pa.binary(),
            "times": pa.binary(),
        }
    )


def _frequencies(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = None
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                block = block or _Block(path, number, batch["doc_id"].type)
                block.add(doc_id, text)
                if block.full():
                    yield from block.close(buckets)
                    block, number = None, number + 1
        if block:
            yield from block.close(buckets)

    return run


#: Blocks whose sums a task holds before it hands them on.
_HELD = 512


def _multiplied(path: str):
    """Sums of each block over the pre-tokens of a task; blocks themselves are passed on."""

    def rows(sums: dict[int, np.ndarray], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
        table = {name: [] for name in names}
        for block, found in sums.items():
            docs = np.flatnonzero(found)
            for name in names:
                table[name].append(None)
            table["block"][-1] = block
            table["docs"][-1] = docs.astype("<u2").tobytes()
            table["times"][-1] = found[docs].astype("<i8").tobytes()
        return pa.RecordBatch.from_pydict({n: pa.array(table[n], schema.field(n).type) for n in names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, sums, schema, names = _pieces(path), {}, None, ["block", "ids", "sizes", "counts", "docs", "times"]
        for batch in batches:
            schema = batch.schema
            head = pa.compute.equal(batch["bucket"], -1)
            yield batch.filter(head).select(names)
            for row in batch.filter(pa.compute.invert(head)).to_pylist():
                if row["block"] not in sums and len(sums) >= _HELD:
                    yield rows(sums, names, schema)
                    sums.clear()
                own = sums.setdefault(row["block"], np.zeros(1 << 16, np.int64))
                each = np.fromiter(map(pieces.__getitem__, row["names"]), np.int64, len(row["names"]))
                each = np.repeat(each, np.frombuffer(row["runs"], "<u4")) * np.frombuffer(row["times"], "u1")
                np.add.at(own, np.frombuffer(row["docs"], "<u2"), each)
        if sums:
            yield rows(sums, names, schema)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, from the rows of each block, which follow each other with the block itself first."""
    head, total, id_type = None, None, None

    def done() -> pa.RecordBatch:
        columns = [pa.array(head["ids"], id_type), pa.array(head["sizes"], pa.int64()), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        id_type = batch.schema.field("ids").type.value_type
        for row in batch.to_pylist():
            if row["ids"] is None:
                docs, times = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["times"], "<i8")
                total[docs] += times
                continue
            if head:
                yield done()
            head, total = row, np.array(row["counts"], np.int64)
    if head:
        yield done()


def count_tokens(
    docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes`` (UTF-8)``, n_tokens, over_limit``.

    ``vocabulary`` is the path of a ``.json`` file of ``tokenizers`` on every executor. No token is added at begin or
    end; the added tokens that a text holds count as the library counts them by default.

    Null text is empty: no bytes, no tokens. Ids may be null or repeat, each row is counted by itself. An empty table
    gives no rows. Other columns are ignored.
    """
    path = vocabulary or tokens.default_vocabulary()
    parts = partitions(docs)
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc_id"), present(text).alias("text"))
    block = f"block long, ids array<{kind}>, sizes array<long>, counts array<long>"
    frequencies = texts.mapInArrow(
        _frequencies(path, 4 * parts), f"bucket long, {block}, names array<string>, runs binary, docs binary, times binary"
    )
    # The rows of blocks are dealt by block, so that they do not all meet in one task.
    place = F.when(F.col("bucket") < 0, F.xxhash64("block")).otherwise(F.col("bucket"))
    by_token = frequencies.repartition(parts, place)
    sums = by_token.mapInArrow(_multiplied(path), f"{block}, docs binary, times binary")
    by_block = sums.repartition(parts, "block").sortWithinPartitions("block", F.col("ids").isNull())
    counted = by_block.mapInArrow(_gathered, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
