"""Language identification in two steps: the family first, then the languages within it.

Texts become hashed counts of byte n-grams, of one to four bytes, over the whole text. One linear support vector machine for
each pair of families votes on the family; within the chosen one, a machine for each pair of
its languages votes on the language. All machines are rows of one matrix of fixed width, which is all that tasks need.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ranklake.llm.common import present, unused
from ranklake.session import settle

#: Families of languages that are often mistaken for each other. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "pl", "cs", "sk"),
    "indic": ("hi", "mr", "ne"),
    "uralic": ("fi", "et"),
    "semitic": ("ar", "fa", "ur"),
    "malayic": ("id", "ms"),
}
UNKNOWN = "und"
WIDTH_LOG = 12
WIDTH = 1 << WIDTH_LOG
PER_LANGUAGE = 400
_PIECE = 1 << 20
_LETTER = r"\p{L}"


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed n-grams, as a vector of length one."""
    counts = np.zeros(WIDTH)
    text = b" " + text.lower() + b" "
    for at in range(0, len(text), _PIECE):
        b = np.frombuffer(text[at : at + _PIECE + 3], np.uint8).astype(np.uint32)
        gram = b
        for n in range(1, 5):
            if n > 1:
                gram = gram[: len(gram) - 1] * np.uint32(0x01000193) ^ b[n - 1 :]
            own = gram[: min(_PIECE, len(gram))]  # those that start in this piece
            mixed = (own + np.uint32(n)) * np.uint32(0x9E3779B1)
            counts += np.bincount(mixed >> np.uint32(32 - WIDTH_LOG), minlength=WIDTH)
    root = np.sqrt(counts)
    return root / np.linalg.norm(root)


def fit(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 15) -> np.ndarray:
    """A linear support vector machine for ``y`` of 1 and -1, by dual coordinate descent.

    The loss is the squared hinge; classes weigh the same, however many rows they have. The last weight is the constant.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    soft = share / cost  # the diagonal that the squared hinge adds, for 1 / (2 C)
    norms = (x**2).sum(axis=1) + soft
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (x[i] @ w) - 1 + soft[i] * alpha[i]) / norms[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w


@dataclass
class Model:
    """``weights`` has a row per machine; ``families`` and ``languages`` say between which two names each decides."""

    families: list[str]
    languages: dict[str, list[str]]
    family_pairs: list[tuple[int, int, int]]
    language_pairs: dict[str, list[tuple[int, int, int]]]
    weights: np.ndarray

    def predict(self, text: bytes) -> tuple[str, float]:
        margins = self.weights @ np.append(features(text), 1.0) if len(self.weights) else np.empty(0)
        chosen, sure = _vote(len(self.families), self.family_pairs, margins)
        name = self.families[chosen]
        inner, surer = _vote(len(self.languages[name]), self.language_pairs[name], margins)
        return self.languages[name][inner], float(sure * surer)


def _vote(n: int, pairs: list[tuple[int, int, int]], margins: np.ndarray) -> tuple[int, float]:
    """The winner by votes, then by the sum of margins; how sure, from the narrowest of its machines."""
    votes, sums, least = np.zeros(n), np.zeros(n), np.full(n, np.inf)
    for a, b, row in pairs:
        m = margins[row]
        votes[a if m > 0 else b] += 1
        sums[a] += m
        sums[b] -= m
        least[a], least[b] = min(least[a], m), min(least[b], -m)
    best = int(np.lexsort((-sums, -votes))[0])
    return best, 1.0 if np.isinf(least[best]) else float(1 / (1 + np.exp(-3 * np.clip(least[best], -10, 10))))


def train(x: np.ndarray, languages: np.ndarray) -> Model:
    """Fit all machines. ``x`` has the features of the sample in rows."""
    known = sorted(set(languages.tolist()))
    groups: dict[str, list[str]] = {}
    for language in known:
        groups.setdefault(family(language), []).append(language)
    names = sorted(groups)
    owner = np.array([names.index(family(v)) for v in languages])
    rows, family_pairs, language_pairs = [], [], {name: [] for name in names}

    def machine(first: np.ndarray, second: np.ndarray) -> int:
        used = first | second
        rows.append(fit(x[used], np.where(first[used], 1.0, -1.0)))
        return len(rows) - 1

    for a, b in combinations(range(len(names)), 2):
        family_pairs.append((a, b, machine(owner == a, owner == b)))
    for name in names:
        for a, b in combinations(range(len(groups[name])), 2):
            row = machine(languages == groups[name][a], languages == groups[name][b])
            language_pairs[name].append((a, b, row))
    return Model(names, groups, family_pairs, language_pairs, np.array(rows))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()).astype(np.float32).tobytes() for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(found, pa.binary())], names=["lang", "x"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches, pa.schema([("lang", pa.string()), ("x", pa.binary())]))
    if len(rows):
        rows = rows.sort_by([("lang", "ascending"), ("x", "ascending")])
        x = np.concatenate([np.frombuffer(v.as_buffer(), np.float32) for v in rows["x"]]).reshape(len(rows), WIDTH).astype(np.float64)
        model = pickle.dumps(train(x, np.array(rows["lang"].to_pylist())))
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit on a bounded sample: at most ``per_language`` whole texts of each language, by the hash of their ids.

    Rows without language, letters or outside the learning part are not used. None if no row is left.
    """
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.col(lang).alias("lang"), present(text).alias("_text"),
        F.xxhash64(F.col(doc_id), F.lit("sample")).alias("_at"),
    )
    usable = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("_id")) & F.col("_text").rlike(_LETTER))
    # About twice as many as needed are ranked, however many rows and tasks there are.
    counts = settle(usable.groupBy("lang").agg(F.count("*").alias("_all")), "langid-counts")
    share = F.pmod("_at", F.lit(1 << 40)) / float(1 << 40)
    near = usable.select("lang", "_at", "_id").join(counts, "lang").where(share * F.col("_all") <= 2 * per_language)
    order = Window.partitionBy("lang").orderBy(F.pmod("_at", F.lit(1 << 40)), "_at", "_id")
    ids = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    chosen = F.broadcast(ids.select("lang", "_at").distinct())  # per_language rows of each language at most
    sample = usable.join(chosen, ["lang", "_at"], "left_semi").dropDuplicates(["lang", "_at"])
    sample = sample.select("lang", F.col("_text").cast("binary").alias("text"))
    # Features of bounded size, of a bounded sample: one task fits them, and only the model comes back.
    fitted = sample.mapInArrow(_features, "lang string, x binary").repartition(1).mapInArrow(_fit, "model binary")
    found = fitted.collect()
    return pickle.loads(found[0].model) if found else None


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score`` (and the columns ``keep``).

    Only the text decides. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if there was nothing to learn from. Long texts are read in pieces, whole. Repeated rows stay;
    an empty table gives no rows; other columns are ignored.
    """
    lettered = F.col(text).rlike(_LETTER)
    # A text that is kept goes to the tasks once.
    shared = text in keep and docs.schema[text].dataType == StringType()
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
        (lettered if shared else F.when(lettered, F.col(text)).cast("binary")).alias("_text"), *keep,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, usable = (batch[text].cast(pa.binary()), batch["_text"].fill_null(False)) if shared else (batch["_text"], batch["_text"].is_valid())
            found = [
                model.predict(t.as_py()) if model and u else (UNKNOWN, 0.0) for t, u in zip(body, usable.to_pylist())
            ]
            arrays = [batch["doc_id"], batch["held_out"], pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())]
            arrays += [batch[c] for c in keep]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score", *keep])

    kept = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double" + kept)


def drop_unknown(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose language could be told. Same columns."""
    own = dict(zip(docs.columns, unused(docs, *(f"c{i}" for i in range(len(docs.columns))))))
    kept = identify(docs.toDF(*own.values()), model, own[doc_id], own[text], keep=tuple(own.values()))
    return kept.where(F.col("lang_pred") != UNKNOWN).select(*own.values()).toDF(*own)
