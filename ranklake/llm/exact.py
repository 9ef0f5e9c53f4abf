"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal if they are identical after each run of ASCII white space is read as one space.
Rows of a length that no other row has are settled by the length; of the others, rows whose first
characters no other row of that length shares are settled by the prefix hash; only the rows that
remain are compared by the SHA-256 of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklake.llm.common import SPACES, first_of, key_of, present, unused
from ranklake.session import settle

PREFIX = 64


def normalised(name: str) -> Column:
    # Most texts have single blanks only and are not made anew.
    text = present(name)
    return F.when(text.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(text, SPACES, " ")).otherwise(text)


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest_all: bool = False, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256`` (and ``row``).

    ``keep_id`` is the smallest id among rows of equal text; its row is ``kept``. ``text_sha256`` is
    null where length or prefix decided, unless ``digest_all`` asks for the digest of every row. A large
    group costs one partial result per task before the shuffle, and the join that hands
    its result back to the rows is one that Spark splits.

    Null text is empty. A null id sorts after all others. Of repeated rows with the same id and text
    one is kept. An empty table gives no rows. Other columns are ignored; ``row`` names a column that
    identifies rows, returned too, else one is made.
    """
    norm = F.col("_norm")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("_row"),
        normalised(text).alias("_norm"),
    )
    full = F.sha2(norm.cast("binary"), 256)
    keyed = rows.select(
        "doc_id", "_row", F.length(norm).alias("_length"), F.xxhash64(F.substring(norm, 1, PREFIX)).alias("_prefix"),
        *([full.alias("_full")] if digest_all else [norm]),
    )
    keyed = settle(keyed, "exact-keys")

    lengths = keyed.groupBy("_length").count().where("count > 1").select("_length")
    paired = keyed.select("_length", "_prefix").join(lengths, "_length", "left_semi")
    prefixes = paired.groupBy("_length", "_prefix").count().where("count > 1").select("_length", "_prefix")
    left = keyed.join(settle(prefixes, "exact-prefixes"), ["_length", "_prefix"], "left_semi")
    left = left if digest_all else left.withColumn("_full", full).drop("_norm")
    left = settle(left, "exact-left")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("_row").alias("at")))
    groups = (
        left.groupBy("_length", "_full")
        .agg(first.alias("_first"), F.count("*").alias("_size"))
        .where("_size > 1")
        .select("_full", F.col("_first.id").alias("_keep"), F.col("_first.at").alias("_at"), "_size")
    )
    if digest_all:
        marked = keyed.join(groups, "_full", "left")
    else:
        alone = keyed.select("doc_id", "_row").join(left.select("_row"), "_row", "left_anti")
        marked = left.join(groups, "_full", "left").unionByName(alone, allowMissingColumns=True)
    single = F.col("_size").isNull()
    return marked.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("_row") == F.col("_at"))).alias("kept"),
        F.col("_full").alias("text_sha256"),
        *([F.col("_row").alias(row)] if row else []),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text. Same columns.

    The texts are read once for their digests and once to be kept, and only then shuffled.
    """
    own, full = unused(docs, "id", "full")
    kept = mark_copies(docs, doc_id, text, digest_all=True).where("kept")
    kept = settle(kept.select(key_of(F.col("doc_id")).alias(own), F.col("text_sha256").alias(full)), "exact-kept")
    named = docs.withColumns({own: key_of(F.col(doc_id)), full: F.sha2(normalised(text).cast("binary"), 256)})
    return first_of(named.join(kept, [own, full], "left_semi"), [own, full]).select(*docs.columns)
