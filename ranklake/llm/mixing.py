"""Mix sources to target weights: whole epochs first, then a weighted sample without replacement.

Each source gets a budget of words. As many complete epochs as fit are taken first. What remains
is a sample of the source by exponential keys (Efraimidis and Spirakis): a document of quality
weight ``w`` draws ``-ln(u) / w`` with ``u`` from a hash of its id, and the documents with the
smallest keys are taken until their words reach the budget.

The order within a source is found without sorting the source. Keys fall into a fixed number of
buckets; bucket sums, made before the shuffle, tell the bucket in which the budget runs out. Documents in
buckets before it are taken, those after it are not, and only that one bucket is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.llm.common import WORD, key_of, present, uniform, unused
from ranklake.session import settle

BUCKETS = 1 << 12


def word_count(name: str) -> Column:
    return F.regexp_count(present(name), F.lit(WORD)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Words to take of each source. ``totals`` has ``source`` and ``source_size``, a row per source.

    Sources in code point order, null last, weigh ``weights``, repeating. They share ``share`` times
    all words in proportion to weight; none gets more than ``most`` times what it has, and what is
    over goes to the others by weight. That is a water level: each source gets its weight
    times the level, or its cap if that is less.
    """
    repeating = F.array(*(F.lit(float(w)) for w in weights))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = totals.withColumn("_weight", repeating[F.pmod(place, F.lit(len(weights)))]).withColumn(
        "_cap", F.col("source_size") * F.lit(float(most))
    )
    everything = Window.partitionBy()
    full_first = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    open_weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    leveled = ranked.withColumn("_level", rest / open_weight)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("_weight"), F.col("_level"))
    leveled = leveled.withColumn("_level", F.max(fits).over(everything))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return leveled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    quality: DataFrame | None = None,
    quality_weights: tuple[float, float, float] = (2.0, 0.5, 1.0),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes: one row per row of ``docs``.

    Returns ``doc_id, size, source, source_size, target, epochs, extra, taken``. ``epochs`` is how
    often the whole document is taken; ``extra`` is how many of its words are taken once more: all,
    none, or, for the one document on which the budget runs out, the first so many that the source
    meets its target to the word. ``taken`` is ``epochs * size + extra``.

    ``quality`` has ``doc_id`` and ``quality``; 1, 0 and unknown weigh ``quality_weights``. If it repeats a
    document, the best row counts. The sources themselves are listed in one task: the recipe of a
    mix names them. Null text has size 0; a null source is a source of its own; a null id draws a key like any
    other; repeated rows count and are taken one by one. An empty table gives no rows. Other columns are ignored.
    """
    good, bad, unknown = (F.lit(float(w)) for w in quality_weights)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")
    )
    if quality is None:
        rows = rows.withColumn("_weight", unknown)
    else:
        best = quality.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
        weight = F.when(F.col("_quality") == 1, good).when(F.col("_quality") == 0, bad).otherwise(unknown)
        rows = rows.join(best, "doc_id", "left").withColumn("_weight", weight)
    rows = rows.select(
        "doc_id", "source", "size", key_of(F.col("source")).alias("_source"),
        (-F.ln(uniform(F.col("doc_id"))) / F.col("_weight")).alias("_key"),
    )
    rows = rows.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * BUCKETS).cast("int"))
    rows = settle(rows, "mix-rows")

    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long"))
    budget = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    targets = targets.withColumn("_budget", budget).withColumn("_source", key_of(F.col("source")))
    targets = settle(targets, "mix-targets")

    buckets = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    ends = (
        buckets.join(targets.select("_source", "_budget"), "_source")
        .where((F.col("_before") < F.col("_budget")) & (F.col("_before") + F.col("_words") >= F.col("_budget")))
        .select("_source", F.col("_bucket").alias("_end"), "_before")
    )
    limits = settle(targets.drop("source").join(ends, "_source", "left"), "mix-limits")

    placed = rows.join(limits, "_source")
    inside = F.col("_bucket") == F.col("_end")
    extra = F.when(F.col("_bucket") < F.col("_end"), F.col("size")).otherwise(F.lit(0).cast("long"))
    sure = placed.where(~F.coalesce(inside, F.lit(False))).withColumn("extra", extra)
    ordered = Window.partitionBy("_source").orderBy("_key", "doc_id", "size")
    earlier = F.coalesce(F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.col("_budget") - F.col("_before") - earlier
    edge = placed.where(inside).withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken")
    return sure.unionByName(edge).select(
        "doc_id", "size", "source", "source_size", "target", "epochs", "extra", taken
    )


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its first ``count`` words, spaces between them kept."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), F.greatest(count, F.lit(0)).cast("int")), "")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", **settings) -> DataFrame:
    """The mix itself: each document as often as it is taken, a part of one cut to the words taken.

    Same columns as ``docs``. Rows that share an id and a size share their lot in turn: ids should be unique.
    Documents without words are left out, as nothing of them is taken.
    """
    own, size, epochs, extra, words, take = map(F.col, names := unused(docs, "id", "size", "epochs", "extra", "words", "take"))
    lot = mix(docs, doc_id=doc_id, text=text, **settings).where("taken > 0")
    lot = lot.groupBy(F.col("doc_id").alias(names[0]), F.col("size").alias(names[1])).agg(
        F.max("epochs").alias(names[2]), F.max("extra").alias(names[3])
    )
    joined = docs.withColumn(names[4], word_count(text)).join(lot, F.col(doc_id).eqNullSafe(own) & (words == size))
    whole = F.array_repeat(words, epochs.cast("int"))
    takes = F.when(extra > 0, F.concat(whole, F.array(extra))).otherwise(whole)
    copies = joined.withColumn(names[5], F.explode(takes))
    part = take < words
    cut = copies.withColumn(text, F.when(part, first_words(F.col(text), take)).otherwise(F.col(text)))
    if n_chars in docs.columns:
        cut = cut.withColumn(n_chars, F.when(part, F.length(text).cast("long")).otherwise(F.col(n_chars)))
    return cut.select(*docs.columns)
