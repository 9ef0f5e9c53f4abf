"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary texts.

The models are over characters within words: the next character given up to six before it, the word's start
included. Counts come from all labelled rows of the learning part. Each class discounts its own counts
and backs off to one model shared by both, estimated from the pooled counts. That model backs off to continuation
counts (before how many characters an n-gram was seen) at every order below, down to a single character, and from there to all being
equally likely. So a rare expression only moves as far as its discounted count carries it; one that was not seen
after its context is judged by what each class keeps back for such, and after an unseen context it is equally likely to both.

A text is scored by its log-likelihood ratio for each word and for the whole text, over its number of words, and by that of its
most toxic words. A logistic fit turns these into a probability. It is made with models that have not counted its rows; the
models that score then count them too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ranklake.llm.common import present
from ranklake.operators.dedup import cap_per_key
from ranklake.session import settle

ORDER = 7
DISCOUNT = 0.75
#: Probability of a character where no order is left.
UNIFORM = 1 / 64
#: Tasks hold the log ratios of so many n-grams and contexts at most, of those counted most; the others are joined.
HELD = 1 << 22
#: At most so many labelled rows, by the hash of their ids, set the logistic fit. All are counted.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3
_PIECE = 1 << 20
#: Bytes of words, and of what holds each, that a task remembers the sums of.
_REMEMBERED, _PER_WORD = 1 << 25, 100
_SPACE = 32


def _letters() -> np.ndarray:
    """Bytes that belong to words stay; all others become a space."""
    table = np.full(256, _SPACE, np.uint8)
    for first, last in ((ord("a"), ord("z")), (128, 255), (ord("'"), ord("'"))):
        table[first : last + 1] = np.arange(first, last + 1)
    return table


_TABLE = _letters()
_LETTERS = _TABLE.tobytes()
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(ORDER + 1)], np.uint64)


def grams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, and the first one of each word.

    An n-gram is a number: its last byte is lowest. It never reaches back beyond the space before its word;
    the space after a word is the last character of that word.
    """
    b = _TABLE[np.frombuffer(b" " + text + b" ", np.uint8)]
    space = b == _SPACE
    kept = ~space
    kept[1:] |= ~space[:-1]  # of a run of spaces the first stays
    if not space[1:].all():
        b, space = b[kept], space[kept]
    else:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if b[0] != _SPACE:  # the kept space after a leading run is always there
        b, space = np.r_[np.uint8(_SPACE), b], np.r_[True, space]
    n = len(b)
    padded = np.concatenate([np.zeros(7, np.uint8), b])
    window = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    ends = np.flatnonzero(space)
    starts = ends[:-1]
    size = np.diff(ends)  # characters of each word with the space after it
    reach = np.minimum(np.arange(1, n) - np.repeat(starts, size) + 1, ORDER)
    return window[1:] & _MASKS[reach], starts


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the shuffle to the labels, with their sizes."""
    codec = pa.Codec("zstd")
    for batch in batches:
        texts = [t.as_py() for t in batch["text"]]
        packed = pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())
        arrays = [batch["doc_id"], batch["late"], packed, pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "late", "text", "size"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for batch in batches:
        found: dict[tuple[int, bool], list[np.ndarray]] = {}
        for packed, size, *kind in zip(*(batch[c].to_pylist() for c in ("text", "size", "toxic", "late"))):
            text = codec.decompress(packed, size, asbytes=True)
            found.setdefault(tuple(kind), []).extend(grams(p)[0] for p in _pieces(text))
        for (toxic, late), parts in found.items():
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                columns = [np.zeros(len(n), np.int64) for _ in range(4)]
                for own in (toxic, 2 + toxic)[: 1 + late]:
                    columns[own] = n
                arrays = [pa.array(keys.astype(np.int64)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "ordinary", "toxic", "late_ordinary", "late_toxic"])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size, cut at spaces."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        end = len(text) if end >= len(text) else text.find(b" ", end)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _shorter(gram: Column) -> Column:
    """An n-gram without its first character."""
    found = F.lit(0).cast("long")
    for n in range(1, ORDER):
        found = F.when(gram >= 1 << 8 * n, gram.bitwiseAND(F.lit((1 << 8 * n) - 1).cast("long"))).otherwise(found)
    return found


def lower_orders(counts: DataFrame) -> DataFrame:
    """``short, lower``: probability of the last character of every n-gram that ends a longer one of ``counts``.

    Kneser-Ney at each order: of the continuation counts after a context some is kept back for the next order's probability,
    until the last order takes each character as equally likely. An order is written before the next one meets it.
    """
    ends = [F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1).cast("long")) for n in range(1, ORDER + 1)]
    kinds = counts.select(F.explode(F.array_distinct(F.array(*ends))).alias("gram")).distinct().where("gram > 255")
    continued = kinds.groupBy(_shorter(F.col("gram")).alias("short")).agg(F.count("*").alias("before"))
    continued = continued.withColumn("context", F.shiftright("short", 8))
    totals = continued.groupBy("context").agg(F.sum("before").alias("all"), F.count("*").alias("kinds"))
    terms = continued.join(totals, "context").select(
        "short", sum((F.col("short") >= 1 << 8 * n).cast("int") for n in range(ORDER - 1)).alias("order"),
        (F.greatest(F.col("before") - DISCOUNT, F.lit(0.0)) / F.col("all")).alias("own"),
        (DISCOUNT * F.col("kinds") / F.col("all")).alias("kept_back"),
    )
    terms = settle(terms, "toxicity-orders")
    orders: list[DataFrame] = []
    for order in range(1, ORDER):
        these = terms.where(F.col("order") == order)
        if orders:
            below = orders[-1].select(F.col("short").alias("next"), F.col("lower").alias("below"))
            these = these.withColumn("next", _shorter(F.col("short"))).join(below, "next")
        else:
            these = these.withColumn("below", F.lit(UNIFORM))
        lower = F.col("own") + F.col("kept_back") * F.col("below")
        orders.append(settle(these.select("short", lower.alias("lower")), "toxicity-order"))
    return reduce(DataFrame.unionByName, orders)


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram, ratio, n``: log of toxic over ordinary probability of each n-gram's last character.

    ``counts`` has ``gram, ordinary, toxic``, a row per n-gram. All sums are by context, so the hottest
    group is as large as the alphabet.
    """
    grams = counts.select("gram", "ordinary", "toxic", F.shiftright("gram", 8).alias("context"), _shorter(F.col("gram")).alias("short"))
    seen = lambda c: F.sum((F.col(c) > 0).cast("long"))
    contexts = grams.groupBy("context").agg(
        F.sum("ordinary").alias("o_all"), F.sum("toxic").alias("t_all"),
        seen("ordinary").alias("o_types"), seen("toxic").alias("t_types"), F.count("*").alias("types"),
    )
    joined = grams.join(contexts, "context").join(lower_orders(counts), "short")
    d = DISCOUNT
    n = F.col("ordinary") + F.col("toxic")
    shared = (F.greatest(n - d, F.lit(0.0)) + d * F.col("types") * F.col("lower")) / (F.col("o_all") + F.col("t_all"))

    def of(count: str, total: str, types: str):
        own = (F.greatest(F.col(count) - d, F.lit(0.0)) + d * F.col(types) * F.col("shared")) / F.col(total)
        return F.when(F.col(total) > 0, own).otherwise(F.col("shared"))

    ratio = F.ln(of("toxic", "t_all", "t_types")) - F.ln(of("ordinary", "o_all", "o_types"))
    return joined.withColumn("shared", shared).select("gram", ratio.alias("ratio"), n.alias("n"))


def back_offs(counts: DataFrame) -> DataFrame:
    """``gram, ratio, n`` for contexts: log of toxic over ordinary weight of a character not seen after it.

    What the shared model says of the character is the same on both sides. ``gram`` has a zero byte for it.
    """
    contexts = counts.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        *(F.sum(c).alias(c) for c in ("ordinary", "toxic")), *(F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in ("ordinary", "toxic"))
    )

    def of(c: str) -> Column:
        return F.when(F.col(c) > 0, DISCOUNT * F.col(f"{c}_types") / F.col(c)).otherwise(1.0)

    found = contexts.select(
        F.shiftleft("context", 8).alias("gram"), (F.ln(of("toxic")) - F.ln(of("ordinary"))).alias("ratio"),
        (F.col("ordinary") + F.col("toxic")).alias("n"),
    )
    return found.where("ratio <> 0")


@dataclass
class Ratios:
    """Log ratios: those that tasks hold, by n-gram in order, and the table of all, or None if all are held."""

    grams: np.ndarray
    values: np.ndarray
    every: DataFrame | None


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [pa.array([batch[c].to_numpy().tobytes()], pa.binary()) for c in ("gram", "ratio")]
        yield pa.RecordBatch.from_arrays(data, names=["grams", "ratios"])


def ratios(counts: DataFrame) -> Ratios:
    """The log ratios of n-grams and of contexts. What is held is all from some power of two of the count on."""
    every = settle(log_ratios(counts).unionByName(back_offs(counts)), "toxicity-ratios")
    power = F.length(F.bin("n"))
    sizes = dict(every.groupBy(power.alias("power")).count().collect())
    held, least = 0, 65
    for p in sorted(sizes, reverse=True):
        if held + sizes[p] > HELD:
            break
        held, least = held + sizes[p], p
    keys, values, at = np.empty(held, np.int64), np.empty(held), 0
    for row in every.where(power >= least).select("gram", "ratio").mapInArrow(_block, "grams binary, ratios binary").toLocalIterator():
        found = np.frombuffer(row.grams, np.int64)
        keys[at : at + len(found)], values[at : at + len(found)] = found, np.frombuffer(row.ratios)
        at += len(found)
    order = np.argsort(keys)
    return Ratios(keys[order], values[order], None if held == sum(sizes.values()) else every)


class _Words:
    """The sum of the log ratios of each word. Where n-grams are not held, it is not a number, and ``open`` has the rest."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, whole: bool):
        self.keys, self.values, self.whole = keys, values, whole
        self.sums: dict[bytes, float] = {}
        self.open: dict[bytes, tuple[float, list[int]]] = {}
        self.size = 0

    def _find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return np.where(hit, self.values[at], 0.0), hit

    def of(self, words: list[bytes]) -> np.ndarray:
        if self.size > _REMEMBERED:
            self.sums, self.open, self.size = {}, {}, 0
        new = [w for w in set(words) if w not in self.sums]
        if new:
            self._add(new)
        return np.fromiter(map(self.sums.__getitem__, words), float, len(words))

    def _add(self, new: list[bytes]) -> None:
        found, starts = grams(b" ".join(new))
        found = found.astype(np.int64)
        value, hit = self._find(found)
        if self.whole:
            value[~hit] = self._find(found[~hit] & -256)[0]
        sums = np.add.reduceat(value, starts)
        if not self.whole:
            ends = np.r_[starts[1:], len(found)]
            for i in np.flatnonzero(np.add.reduceat((~hit).astype(np.int64), starts)):
                own = slice(starts[i], ends[i])
                self.open[new[i]] = float(sums[i]), found[own][~hit[own]].tolist()
                sums[i] = np.nan
        self.sums.update(zip(new, sums.tolist()))
        self.size += sum(map(len, new)) + _PER_WORD * len(new)


_OPEN = pa.list_(pa.struct([("part", pa.float64()), ("times", pa.int64()), ("grams", pa.list_(pa.int64()))]))


def _scanned(shared, whole: bool):
    def one(text: bytes, words: _Words) -> tuple:
        total, n, best, rest = 0.0, 0, np.empty(0), Counter()
        states: dict[bytes, tuple[float, list[int]]] = {}
        for piece in _pieces(text):
            found = piece.translate(_LETTERS).split()
            sums = words.of(found)
            n += len(found)
            if not whole:
                missing = np.isnan(sums)
                lacking = [found[i] for i in np.flatnonzero(missing)]
                rest.update(lacking)
                states.update((w, words.open[w]) for w in lacking)
                sums = sums[~missing]
            total += sums.sum()
            best = np.sort(np.r_[best, sums if len(sums) < 4 else np.partition(sums, -3)[-3:]])[-3:]
        return total, n, best, [{"part": states[w][0], "times": k, "grams": states[w][1]} for w, k in rest.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(*shared.value, whole)
        for batch in batches:
            total, n, best, rest = zip(*(one(t.as_py(), words) for t in batch["text"])) if len(batch) else ((),) * 4
            names = [c for c in batch.schema.names if c != "text"]
            found = [pa.array(total, pa.float64()), pa.array(n, pa.int64()), pa.array(best, pa.list_(pa.float64())), pa.array(rest, _OPEN)]
            yield pa.RecordBatch.from_arrays([batch[c] for c in names] + found, names=[*names, "total", "words", "best", "open"])

    return run


def _completed(found: DataFrame, every: DataFrame) -> DataFrame:
    """``found`` with the words added whose n-grams are not all held: these are looked up, each once, in the table of all."""
    found = settle(found.withColumn("row", F.monotonically_increasing_id()), "toxicity-open")
    words = found.select("row", F.posexplode("open").alias("at", "word")).select("row", "at", "word.*")
    each = words.withColumn("gram", F.explode("grams")).drop("grams")
    lost = each.select("gram").distinct().withColumn("back", F.col("gram").bitwiseAND(F.lit(-256)))
    backs = every.select(F.col("gram").alias("back"), F.col("ratio").alias("back_ratio"))
    known = lost.join(every.select("gram", "ratio"), "gram", "left").join(backs, "back", "left")
    known = settle(known.select("gram", F.coalesce("ratio", "back_ratio", F.lit(0.0)).alias("ratio")), "toxicity-lost")
    sums = each.join(known, "gram").groupBy("row", "at", "times").agg((F.max("part") + F.sum("ratio")).alias("value"))
    sums = settle(sums, "toxicity-words")
    totals = sums.groupBy("row").agg(F.sum(F.col("value") * F.col("times")).alias("more"))
    several = sums.select("row", F.explode(F.array_repeat("value", F.least("times", F.lit(3)).cast("int"))).alias("value"))
    top = cap_per_key(several, ["row"], [F.desc("value")], 3).groupBy("row").agg(F.collect_list("value").alias("top"))
    joined = found.join(totals, "row", "left").join(top, "row", "left")
    best = F.concat("best", F.coalesce("top", F.array().cast("array<double>")))
    return joined.withColumns({"total": F.col("total") + F.coalesce("more", F.lit(0.0)), "best": best}).drop("row", "more", "top")


def measured(rows: DataFrame, model: Ratios) -> DataFrame:
    """``rows`` with ``measures`` for their ``text``.

    These are, of the whole text, the log ratio per word, the largest of a word, the sum of the three largest over three, and log words.
    """
    kept = [f for f in rows.schema if f.name != "text"]
    shared = rows.sparkSession.sparkContext.broadcast((model.grams, model.values))
    word = StructType().add("part", "double").add("times", "long").add("grams", ArrayType(LongType()))
    schema = StructType(list(kept)).add("total", "double").add("words", "long").add("best", ArrayType(DoubleType())).add("open", ArrayType(word))
    found = rows.mapInArrow(_scanned(shared, model.every is None), schema)
    if model.every is not None:
        found = _completed(found, model.every)
    top = F.slice(F.sort_array("best", asc=False), 1, 3)
    measures = F.array(
        F.col("total") / F.greatest("words", F.lit(1)), F.coalesce(F.array_max("best"), F.lit(0.0)),
        F.aggregate(top, F.lit(0.0), lambda a, x: a + x) / 3, F.log1p("words"),
    )
    return found.select(*(f.name for f in kept), measures.alias("measures"))


@dataclass
class Model:
    """The log ratios, and the logistic fit over standardised measures."""

    ratios: Ratios
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, measures: Column) -> Column:
        total = F.lit(float(self.weights[-1]))
        for i, (center, scale, weight) in enumerate(zip(self.center, self.scale, self.weights)):
            x = (measures[i] - float(center)) / float(scale)
            total += F.greatest(F.lit(-20.0), F.least(F.lit(20.0), x)) * float(weight)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Weights and constant of a logistic fit, by Newton steps; the constant is hardly held back."""
    x = np.hstack([x, np.ones((len(x), 1))])
    hold = np.diag([penalty] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + hold @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, slope)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
    return w


def _part(column: Column) -> Column:
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4, F.lit(0))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Count all labelled rows of the learning part (``crc32(id) mod 4`` other than 2), whole texts, and fit the scores.

    Texts meet their labels in a shuffle, compressed; only the labels of a partition are held in memory.
    Ids of remainder 3 set the logistic fit, at most ``CALIBRATION_ROWS`` of them, each by one text, with models of the others. A document
    with several labels is toxic if one says so; a null label is none. Without both classes the
    score is the share of toxic rows, or 0.
    """
    usable = labels.where(F.col("toxic").isNotNull() & (_part(F.col("doc_id")) != 2))
    marks = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = settle(marks, "toxicity-labels")
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.lower(present(text)).cast("binary").alias("text"), _part(F.col(doc_id)).alias("part")
    )
    learning = texts.where("part <> 2").select("doc_id", (F.col("part") == 3).alias("late"), "text")
    packed = learning.mapInArrow(_packed, StructType([*learning.schema, StructField("size", LongType())]))
    known = packed.join(marks.hint("shuffle_hash"), "doc_id")
    columns = ("ordinary", "toxic", "late_ordinary", "late_toxic")
    counts = known.select("text", "size", "toxic", "late").mapInArrow(
        _counted, "gram long, " + ", ".join(f"{c} long" for c in columns)
    )
    counts = settle(counts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in columns)), "toxicity-counts")
    early = [(F.col(c) - F.col(f"late_{c}")).alias(c) for c in columns[:2]]
    before = ratios(counts.select("gram", *early).where("ordinary + toxic > 0"))

    late = marks.where(_part(F.col("doc_id")) == 3).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS)
    rows = texts.join(F.broadcast(settle(late, "toxicity-late")), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # of a repeated id, the text that sorts first
    fit = measured(rows.select("toxic", "text"), before).toPandas()
    y = fit["toxic"].to_numpy(float)
    x = np.array(fit["measures"].tolist()).reshape(-1, 4)
    if len(set(y)) < 2:
        share = y.mean() if len(y) else 0.0
        return Model(before, np.zeros(4), np.ones(4), np.array([0.0] * 4 + [np.log((share + 1e-9) / (1 - share + 1e-9))]))
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(ratios(counts.select("gram", "ordinary", "toxic")), center, scale, logistic((x - center) / scale, y))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Only the text decides. Null and empty texts get the score of a text without words. Long
    texts are read in pieces, whole. Repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (_part(F.col(doc_id)) == 2).alias("held_out"),
        F.lower(present(text)).cast("binary").alias("text"),
    )
    scored = measured(rows, model.ratios).select("doc_id", "held_out", model.score(F.col("measures")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
