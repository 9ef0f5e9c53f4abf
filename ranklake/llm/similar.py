"""Near-duplicate texts by the overlap of their five-word shingles: all pairs, joined in two steps.

Fingerprints over shingles of several words move far apart by few edits: at an overlap of 0.8 they
differ in about nine of 64 bits. Fingerprints over single words, each weighed by the root of its
count, stay within a few bits there, while unrelated texts are about 30 bits apart. So several of them, from different seeds, give
the first candidates: pairs that differ in at most three bits of any one, met under Golay keys as in ``simhash``. A run of over 64
fingerprints under one key gives the pairs of a spanning forest, a fingerprint is compared with the three nearest of those
below it, and documents of one fingerprint with two of them. This links most of a large group with work that grows with its size.

What these links leave apart is then joined without loss. Shingles are put in one order, from seldom to frequent, and two
texts that share enough of them share one of the first few of each (a prefix filter). Texts of different roots that meet under such a
shingle, and whose places in the order leave room for the overlap, may be alike. These pairs are not written down, as a group of texts
that overlap by somewhat less has a number of them that grows with its square: each text goes on once for each shingle under which it
meets another, with a sketch of its shingles that bounds the overlap of two texts from above. Pairs that the sketches leave are
candidates: in a long run first the nearest of each text, then, of what their links leave apart, all.
The order and the sketches only set the work, not the result.
Every candidate pair is checked on the sets of its shingles, and only pairs that pass are links.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklake.llm.common import dense_table, first_of, key_of, present, unused
from ranklake.llm.components import components
from ranklake.llm.simhash import near_links
from ranklake.session import settle

SHINGLE, SIMILARITY, PRINTS = 5, 0.8, 4
#: Fingerprints with which one is compared first, of those that it meets.
NEAREST = 3
#: One word is more of a short text, and moves more bits: up to so many words a text has so many times the fingerprints.
SHORT = ((16, 8), (32, 6), (96, 2))
_REMEMBERED = 100_000
#: Shingles are counted by so many bits of their hash. A run of rows up to this length is compared step by step.
_COUNTED, _LONG = 18, 64
#: Bits of a sketch for each shingle, and the logarithms of the fewest and the most of a text.
_SKETCHED, _BITS = 4, (6, 12)
_SLACK = 1e-6
_WORDS: dict[bytes, int] = {}


def _hash(word: bytes) -> int:
    found = _WORDS.get(word)
    if found is None:
        if len(_WORDS) >= _REMEMBERED:
            _WORDS.clear()
        _WORDS[word] = found = xxhash.xxh64_intdigest(word)
    return found


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Other hashes of the same words: a multiplication by an odd number and two shifts, for each seed its own."""
    odd = np.uint64(xxhash.xxh64_intdigest(b"odd", seed) | 1)
    mixed = (hashes ^ (hashes >> np.uint64(29))) * odd
    return mixed ^ (mixed >> np.uint64(32))


def word_prints(text: bytes, prints: int) -> list[int]:
    """Fingerprints of the words of a text, lower-cased in ASCII; zero if it has none."""
    words = text.lower().split()
    found = Counter(words)
    if not found:
        return [0]
    prints *= next((times for most, times in SHORT if len(words) <= most), 1)
    hashes = np.fromiter(map(_hash, found), np.uint64, len(found))
    # Whole numbers, so that no order of summing matters.
    weights = np.sqrt(np.fromiter(found.values(), np.float64, len(found)) * 65536.0).astype(np.int64)
    out = []
    for seed in range(prints):
        bits = np.unpackbits(_mixed(hashes, seed).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = weights @ bits
        out.append(int(np.packbits(2 * ones > weights.sum(), bitorder="little").view("<i8")[0]))
    return out


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes; of fewer words the whole sequence, of none nothing."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    pieces = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, pieces), np.uint64, len(pieces)))


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles among all of both; 1 where neither has any."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - both
    return both / every if every else 1.0


def sketch(own: np.ndarray) -> bytes:
    """Bits that say whether an odd number of a text's shingles falls on them; their number is a power of two that grows with the text's."""
    bits = 1 << min(max((_SKETCHED * len(own) - 1).bit_length(), _BITS[0]), _BITS[1])
    counts = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length in words of 64 bits: the sketches of that length or more as rows, folded to it, and for each sketch its row (-1: none)."""
    words = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
    out, held = {}, np.empty(0, np.int64)
    length = int(words.max(initial=0))
    rows = np.empty((0, length), np.uint64)
    while length:
        own = np.flatnonzero(words == length)
        rows = np.concatenate([rows, np.frombuffer(b"".join(sketches[own]), np.uint64).reshape(-1, length)])
        held = np.concatenate([held, own])
        if len(own):
            at = np.full(len(words), -1)
            at[held] = np.arange(len(held))
            out[length] = at, rows
        length //= 2
        rows = rows[:, :length] ^ rows[:, length : 2 * length]
    return out


def differing(folds: dict[int, tuple[np.ndarray, np.ndarray]], one: np.ndarray, two: np.ndarray, most: int = 1 << 14) -> np.ndarray:
    """Bits at which the sketches at ``one`` and ``two`` differ: each needs a shingle that only one of both texts has."""
    out = np.full(len(one), -1)
    for length in sorted(folds, reverse=True):
        at, rows = folds[length]
        able = np.flatnonzero((out < 0) & (at[one] >= 0) & (at[two] >= 0))
        for i in range(0, len(able), most):
            part = able[i : i + most]
            out[part] = np.bitwise_count(rows[at[one[part]]] ^ rows[at[two[part]]]).sum(axis=1, dtype=np.int64)
    return out


def _printed(prints: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [word_prints(t.as_py(), prints) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["id"], pa.array(found, pa.list_(pa.int64()))], names=["node", "id", "prints"])

    return run


def _shingled(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _alike(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch["left"].to_pylist(), batch["right"].to_pylist()
            passed = [overlap(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= similarity for a, b in zip(left, right)]
            yield batch.filter(pa.array(passed, pa.bool_())).select(["a", "b"])

    return run


def prefix(n: int, similarity: float) -> int:
    """Of ``n`` shingles in a common order, how many must be looked at: a text alike shares one of its own first few with them."""
    return n - ceil(similarity * n - _SLACK) + 1 if n else 0


def _counts(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _COUNTED, np.int64)
        for batch in batches:
            for t in batch["text"]:
                np.add.at(counts, (shingle_set(t.as_py(), shingle) >> np.uint64(64 - _COUNTED)).astype(np.int64), 1)
        place = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(counts[place])], names=["place", "value"])

    return run


def _prefixed(shingle: int, similarity: float, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, firsts, sketches = [], [], []
            for t in batch["text"]:
                own = shingle_set(t.as_py(), shingle)
                order = np.lexsort((own, counts[(own >> np.uint64(64 - _COUNTED)).astype(np.int64)]))
                sizes.append(len(own))
                firsts.append(own[order[: prefix(len(own), similarity)]].tobytes())
                sketches.append(sketch(own))
            columns = [batch["node"], pa.array(sizes, pa.int32()), pa.array(firsts, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "firsts", "sketch"])

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a prefix; one of key 0 for a text without words."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            firsts = [np.frombuffer(f.as_py(), np.int64) if f.as_py() else np.zeros(1, np.int64) for f in part["firsts"]]
            if not firsts:
                continue
            taken = pa.array(np.repeat(np.arange(len(firsts)), [len(f) for f in firsts]))
            places = pa.array(np.concatenate([np.arange(len(f), dtype=np.int32) for f in firsts]))
            columns = [pa.array(np.concatenate(firsts)), *(part[c].take(taken) for c in ("node", "root", "size")), places]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "root", "size", "place"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of rows sorted by the first one, in lots that cut no run of it."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(new[0]):
            continue
        held = new if held is None else [np.concatenate(pair) for pair in zip(held, new)]
        whole = int(np.searchsorted(held[0], held[0][-1]))  # the last run may go on in the next batch
        if whole:
            yield [c[:whole] for c in held]
            held = [c[whole:] for c in held]
    if held is not None:
        yield held


def meeting(lot: list[np.ndarray], similarity: float, most: int = 1 << 17) -> Iterator[np.ndarray]:
    """Pairs, in two rows and bounded lots, of the nodes of different roots that meet under a key and may be alike.

    ``lot`` has keys, nodes, roots, sizes and places, sorted by key, and no key goes on outside. If the key is the first shingle of
    both texts' orders that they share, the overlap lies in what comes after it in both, so a pair without room for it is none.
    What has the commonest root of a long run is only compared with what has not, so a group that is linked already costs nothing.
    """
    keys, nodes, roots, sizes, places = lot
    none = sizes == 0
    if none.any():  # texts without words are alike
        yield np.stack([nodes[none], np.full(none.sum(), nodes[none].min())])
        keys, nodes, roots, sizes, places = (c[~none] for c in lot)
    if not len(keys):
        return
    share = similarity / (1 + similarity)
    room = sizes - places
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    apart = np.minimum.reduceat(roots, starts) != np.maximum.reduceat(roots, starts)
    out, held = [], 0
    for s, n in zip(starts[apart & (lengths > _LONG)], lengths[apart & (lengths > _LONG)]):
        node, root, size, left = (c[s : s + n] for c in (nodes, roots, sizes, room))
        kinds, counts = np.unique(root, return_counts=True)
        common = kinds[counts.argmax()]
        for i in np.flatnonzero(root != common):
            able = (root != root[i]) & (np.minimum(left, left[i]) >= share * (size + size[i]) - _SLACK)
            # Two of the rest meet twice; the later one finds the pair.
            able[i:] &= root[i:] == common
            out.append(np.stack([node[able], np.full(able.sum(), node[i])]))
            held += out[-1].shape[1]
            if held >= most:
                yield np.concatenate(out, axis=1)
                out, held = [], 0
    if held:
        yield np.concatenate(out, axis=1)
    short = np.repeat(apart & (lengths <= _LONG), lengths)
    keys, nodes, roots, sizes, room = (c[short] for c in (keys, nodes, roots, sizes, room))
    for step in range(1, min(_LONG, len(keys))):
        one = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(one):
            break
        two = one + step
        able = (roots[one] != roots[two]) & (np.minimum(room[one], room[two]) >= share * (sizes[one] + sizes[two]) - _SLACK)
        yield np.stack([nodes[one[able]], nodes[two[able]]])


def _apart(lot: list[np.ndarray], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the lot of pairs that meet."""
    roots = lot[2]
    for one, two in meeting([lot[0], np.arange(len(roots)), *lot[2:]], similarity):
        apart = roots[one] != roots[two]
        if apart.any():
            yield one[apart], two[apart]


def _meets(similarity: float):
    """The rows that meet another one: no more than are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _runs(batches):
            meets = np.zeros(len(lot[0]), bool)
            for one, two in _apart(lot, similarity):
                meets[one] = meets[two] = True
            if meets.any():
                columns = [pa.array(lot[i][meets]) for i in (0, 1, 3, 4)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "size", "place"])

    return run


def _fitting(similarity: float, nearest: int | None):
    """Pairs whose sketches leave room for the overlap. With ``nearest`` so many for each row that looks for partners in a long run."""
    share = similarity / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _runs(batches):
            nodes, sizes, folds = lot[1], lot[3], folded(lot[5])
            for one, two in _apart(lot[:5], similarity):
                both = sizes[one] + sizes[two]
                apart = differing(folds, one, two)
                fits = np.flatnonzero((both - apart) / 2 >= share * both - _SLACK)
                if nearest:
                    # The second of a pair looks for partners, and all that it meets in a long run are here.
                    order = fits[np.lexsort((apart[fits] / np.maximum(both[fits], 1), two[fits]))]
                    first = np.searchsorted(two[order], two[order])
                    fits = order[(np.arange(len(order)) - first < nearest) | (both[order] == 0)]
                if len(fits):
                    a, b = nodes[one[fits]], nodes[two[fits]]
                    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["node", "other"])

    return run


def _ranked(ends: DataFrame) -> DataFrame:
    """``a, b, place``: close fingerprints, a > b, each ``a`` with its partners from the nearest on."""
    nearest = Window.partitionBy("a").orderBy(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))), F.xxhash64("a", "b"))
    return settle(near_links(ends).withColumn("place", F.row_number().over(nearest)), "similar-links")


def _rooted(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` with the root of their node, itself if no link leads on."""
    return rows.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _meeting(texts: DataFrame, linked: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``key, node, size, place``: where a text meets one that ``linked`` leaves apart and that may be like it; ``node, sketch``.

    Of no pair that is alike and apart a key is missing.
    """
    cells = texts.select("text").mapInArrow(_counts(shingle), "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
    counts = dense_table(settle(cells, "similar-counts"), _COUNTED, "int64")
    firsts = texts.select("node", "text").mapInArrow(_prefixed(shingle, similarity, counts), "node long, size int, firsts binary, sketch binary")
    firsts = settle(firsts, "similar-firsts")
    rooted = _rooted(firsts.select("node", "size", "firsts"), linked).select("node", "root", "size", "firsts")
    keyed = rooted.mapInArrow(_spread, "key long, node long, root long, size int, place int")
    runs = keyed.repartition("key").sortWithinPartitions("key")
    met = settle(runs.mapInArrow(_meets(similarity), "key long, node long, size int, place int"), "similar-met")
    return met, firsts.select("node", "sketch")


def _unjoined(met: DataFrame, sketches: DataFrame, linked: DataFrame, similarity: float, nearest: int | None = None) -> DataFrame:
    """``node, other``: what may be alike and ``linked`` leaves apart. Without ``nearest`` no pair that is alike is missing."""
    rows = _rooted(met, linked).join(first_of(sketches, ["node"]), "node").select("key", "node", "root", "size", "place", "sketch")
    runs = rows.repartition("key").sortWithinPartitions("key")
    return runs.mapInArrow(_fitting(similarity, nearest), "node long, other long")


def _nodes(links: DataFrame, ends: DataFrame) -> DataFrame:
    """Pairs of the nodes that stand for the fingerprints of ``links``."""
    one = ends.select(F.col("fp").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    two = ends.select(F.col("fp").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    ways = F.array(*[F.struct(F.col(f"{x}_a").alias("node"), F.col(f"{x}_b").alias("other")) for x in ("low", "high")])
    return links.select("a", "b").join(one, "a").join(two, "b").select(F.inline(ways))


def _checked(found: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``a, b``: those of the pairs ``node, other`` whose shingles overlap enough."""
    pairs = found.where("node <> other").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
    pairs = settle(pairs.distinct(), "similar-pairs")
    nodes = settle(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "similar-nodes")
    sets = first_of(texts.select("node", "text").join(nodes, "node", "left_semi"), ["node"])
    sets = settle(sets.mapInArrow(_shingled(shingle), "node long, shingles binary"), "similar-sets")
    sided = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    sided = sided.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return settle(sided.mapInArrow(_alike(similarity), "a long, b long"), "similar-alike")


def _joined(rooted: DataFrame, found: DataFrame) -> DataFrame:
    """``node, root`` with the links of ``found`` added."""
    if found.isEmpty():
        return rooted
    return components(found.unionByName(rooted.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "root")


def similar(
    docs: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    prints: int = PRINTS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``node, id, root`` of each distinct pair of id and text: ``root`` is the same where links of ``similarity`` or more lead.

    ``node`` is a hash of id and text. Null text has no words; texts without words are alike. Other columns are ignored.
    ``similarity`` is above 0.
    """
    texts = docs.select(node_of(doc_id, text).alias("node"), F.col(doc_id).cast("long").alias("id"), present(text).cast("binary").alias("text"))
    printed = settle(texts.mapInArrow(_printed(prints), "node long, id long, prints array<long>"), "similar-prints")
    # Fingerprints of all seeds lie in one table: that two of different seeds are close is chance, and the check finds out.
    own = printed.select("node", F.explode("prints").alias("fp"))
    # Two documents stand for all of one fingerprint.
    ends = settle(own.groupBy("fp").agg(F.min("node").alias("low"), F.max("node").alias("high")), "similar-ends")
    same = own.join(ends.where("low < high"), "fp").select("node", F.explode(F.array("low", "high")).alias("other"))
    ranked = _ranked(ends)
    near = _nodes(ranked.where(F.col("place") <= NEAREST), ends)
    rooted = components(_checked(same.unionByName(near), texts, shingle, similarity), "node", "root")
    met, sketches = _meeting(texts, rooted, shingle, similarity)
    rooted = _joined(rooted, _checked(_unjoined(met, sketches, rooted, similarity, NEAREST), texts, shingle, similarity))
    # Shorter runs have given all their pairs.
    long = met.groupBy("key").count().where(F.col("count") > _LONG).select("key")
    met = settle(met.join(long, "key", "left_semi"), "similar-long")
    if not met.isEmpty():
        rooted = _joined(rooted, _checked(_unjoined(met, sketches, rooted, similarity), texts, shingle, similarity))
    every = printed.groupBy("node").agg(F.min("id").alias("id"))
    return every.join(rooted, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))


def node_of(doc_id: str, text: str):
    return F.xxhash64(key_of(F.col(doc_id)), present(text))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group of similar texts stays: that with the smallest id, null last. Same columns.

    Of rows with the same id and text one stays. An empty table stays empty.
    """
    first = F.min_by("node", F.struct(F.col("id").isNull(), F.col("id"), F.col("node"))).alias("node")
    stay = settle(similar(docs, doc_id=doc_id, text=text, **how).groupBy("root").agg(first).select("node"), "similar-stay")
    (name,) = unused(docs, "node")
    named = docs.withColumn(name, node_of(doc_id, text))
    return first_of(named.join(stay.withColumnRenamed("node", name), name, "left_semi"), [name]).select(*docs.columns)
