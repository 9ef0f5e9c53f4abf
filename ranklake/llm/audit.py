"""How filters interact: what each order of filters keeps, removes, and loses at every step.

Each filter leaves one table of the rows that fail it. What survives a prefix of an order depends only on
the set of filters in it, so survivors are found once per set: those of a set and one filter more are the survivors of
the set left-anti joined with that filter's table. What a filter removes after a set are the set's survivors
left-semi joined with its table; what it would remove from all rows, less that, is redundant.
Orders are put together from these counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklake.llm.common import present
from ranklake.session import settle

FEW_WORDS = 200
MOST_CAPITALS = 3
#: Characters that no text should hold, and the capitals that are counted. Fixed values.
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def few_words(text: str, data: bytes, words: list[bytes]) -> bool:
    return len(words) < FEW_WORDS


def repeated_words(text: str, data: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < 50 * len(words)


def many_capitals(text: str, data: bytes, words: list[bytes]) -> bool:
    return 100 * (len(data) - len(data.translate(None, CAPITALS))) > MOST_CAPITALS * len(text)


def has_symbols(text: str, data: bytes, words: list[bytes]) -> bool:
    return len(data.translate(None, SYMBOLS)) < len(data)


#: Filters that see one text, its UTF-8 bytes and its words between ASCII white space: true where it fails.
BY_TEXT: dict[str, Callable[[str, bytes, list[bytes]], bool]] = {
    "A": few_words, "B": repeated_words, "C": many_capitals, "D": has_symbols,
}
#: A copy of a text with a smaller id: this filter needs all rows.
COPIES = "E"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks, digests = {name: [] for name in BY_TEXT}, []
        for text in batch["_text"].to_pylist():
            data = text.encode()
            words = data.split()
            for name, fails in BY_TEXT.items():
                marks[name].append(fails(text, data, words))
            digests.append(hashlib.sha256(data).digest())
        columns = {c: batch[c] for c in ("row", "doc_id", "part")} | {"digest": pa.array(digests, pa.binary())}
        yield pa.RecordBatch.from_pydict(columns | {name: pa.array(m, pa.bool_()) for name, m in marks.items()})


def failing(docs: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The rows (``row, doc_id, part``) and for each filter the table of the rows that fail it.

    The texts are read once. Rows are told apart by a number of their own, so ids may be null or repeat.
    """
    row, key = F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id")
    said = docs.select(row, key, present(part).alias("part"), present(text).alias("_text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    marks = ", ".join(f"{name} boolean" for name in BY_TEXT)
    rows = settle(said.mapInArrow(_judged, f"row long, doc_id {kind}, part string, digest binary, {marks}"), "audit-rows")
    tables = {name: settle(rows.where(name).select("row"), f"audit-fails-{name}") for name in BY_TEXT}
    # One row per repeated text. A text of a third of all rows is one partial result per task, and Spark splits it in the join.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    copies = rows.select("row", "doc_id", "digest").join(first, "digest").where("doc_id > _first").select("row")
    tables[COPIES] = settle(copies, f"audit-fails-{COPIES}")
    return rows.select("row", "doc_id", "part"), tables


def labelled(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: whether any label of the id says so."""
    found = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    no = F.lit(False)
    joined = rows.join(found.where("good or toxic"), "doc_id", "left")
    return joined.select("row", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def survivors(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``alive``: a bit for each set of filters that the row survives, the set being the bit's number.

    A row that passes one filter more survives each of its sets with that filter too. The sets are kept as bits,
    for else each row would be shuffled 32 times.
    """
    alive = rows.withColumn("alive", F.lit(1).cast("long"))
    for bit, fails in enumerate(tables.values()):
        both = F.col("alive").bitwiseOR(F.shiftleft("alive", 1 << bit))
        passed = alive.join(fails, "row", "left_anti").withColumn("alive", both)
        stopped = alive.join(fails, "row", "left_semi")
        alive = settle(passed.unionByName(stopped), f"audit-alive-{bit}")
    return alive


def set_counts(rows: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """For each part, set of filters ``gone`` and filter ``bit`` outside it (-1: survivors of the set): ``n, good, toxic``."""
    alive = survivors(rows, tables)

    def counted(some: DataFrame, bit: int, sets: list[int]) -> DataFrame:
        kinds = some.groupBy("part", "alive").agg(
            F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
        )
        held = F.filter(F.array(*map(F.lit, sets)), lambda s: F.getbit("alive", s) == 1)
        each = kinds.select("part", F.explode(held).alias("gone"), "n", "good", "toxic")
        return each.groupBy("part", "gone").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).withColumn("bit", F.lit(bit))

    every = range(1 << len(tables))
    found = counted(alive, -1, list(every))
    for bit, fails in enumerate(tables.values()):
        removed = alive.join(fails, "row", "left_semi")
        found = found.unionByName(counted(removed, bit, [s for s in every if not s >> bit & 1]))
    return found


def steps(names: list[str]) -> list[tuple[str, int, int, int]]:
    """Order, step, bits of the filters before it, and the bit number of its own filter."""
    out = []
    for order in permutations(range(len(names))):
        gone = 0
        for step, bit in enumerate(order, 1):
            out.append(("".join(names[i] for i in order), step, gone, bit))
            gone |= 1 << bit
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    A null part is ``''``, a null text empty. Each row counts, also where ids repeat; a row is a copy only of a text under
    a smaller id, so a null id is no copy. Of repeated labels any may say good or toxic; those of a null id count for none.
    An empty table has no part and gives no rows. Other columns are ignored.
    """
    rows, tables = failing(docs, part, doc_id, text)
    labels = labels.select(F.col("doc_id"), F.col("quality"), F.col("toxic"))
    names = list(tables)
    rows = settle(labelled(rows, labels), "audit-labelled")
    counts = settle(set_counts(rows, tables), "audit-counts")

    # At most 32 sets and six numbers for each part: one cell per part.
    cell = F.map_from_entries(F.collect_list(F.struct(F.struct("gone", "bit"), F.struct("n", "good", "toxic"))))
    parts = counts.groupBy("part").agg(cell.alias("_counts"))

    def count(gone: Column, bit: Column, field: str = "n") -> Column:
        key = F.struct(gone.cast("int").alias("gone"), bit.cast("int").alias("bit"))
        return F.coalesce(F.try_element_at("_counts", key).getField(field), F.lit(0)).cast("long")

    every = (1 << len(names)) - 1
    # One expression as text: built from columns, its 600 rows are thousands of calls to the JVM.
    plan = ", ".join(f"('{order}', {step}, {gone}, {bit})" for order, step, gone, bit in steps(names))
    at = parts.select("part", "_counts", F.expr(f"inline(array({plan}))").alias("filter_order", "step", "gone", "bit"))
    gone, bit = F.col("gone"), F.col("bit")
    own = F.expr("shiftleft(1, bit)")
    told = at.select(
        "part", "filter_order", "step", "bit",
        count(gone.bitwiseOR(own), F.lit(-1)).alias("kept"),
        count(gone, bit).alias("removed"),
        (count(F.lit(0), bit) - count(gone, bit)).alias("redundant"),
        count(F.lit(every) - own, bit).alias("unique_fails"),
        count(gone, bit, "good").alias("good_lost"),
        count(gone, bit, "toxic").alias("toxic_lost"),
    )
    own_share = F.sum("removed").over(Window.partitionBy("part", "bit"))  # 120 rows each
    return told.withColumn("shapley", own_share).drop("bit")
