"""From raw documents to packed token sequences: five stages, each one of the operators in ``ranklake.llm``.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ranklake.llm import exact, langid, mixing, packing, similar
from ranklake.session import settle


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: those without a letter."""
    return langid.drop_unknown(docs, langid.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, that with the smallest id stays."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that five-word shingles link at 0.8 or more, the document with the smallest id stays."""
    return similar.drop_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source as often as its weight asks for. A document that is taken twice is two rows."""
    return mixing.mixed_documents(docs, quality=spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", tell_language),
    ("exact dedup", drop_copies),
    ("near-duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, language models and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; between them a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
