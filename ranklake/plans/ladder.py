"""Landed ladder pages to the ladder table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.functions.dates import as_timestamp
from ranklake.operators.grid import work_grid
from ranklake.operators.joins import lookup, remaining
from ranklake.operators.normalize import is_done, normalize_entries, outcome
from ranklake.schemas import DAY, LADDER, LADDER_STORED
from ranklake.session import settle
from ranklake.sinks.items import clear_emptied, record_items, scan_items
from ranklake.sinks.tables import conform, overwrite_partitions
from ranklake.sources.pages import explode_entries, key_outcomes, pages_until_empty

CELL = ["platform", "tier", "division"]
FOLDERS = [DAY, "region", "platform", "tier", "division"]


def ladder(pages: DataFrame, apex: DataFrame, platforms: DataFrame, ingested_at) -> DataFrame:
    """Ladder rows from paged tiers and from single-page top tiers.

    Both inputs have the columns of ``LADDER_PAGES``; an apex row has no division.
    """
    paged = pages_until_empty(pages, CELL, status="status").select(*CELL, "entry")
    single = explode_entries(apex.where(outcome("status") == "ok")).select(*CELL, "entry")
    entries = paged.unionByName(single)
    placed = lookup(entries, platforms, "platform", "region", dim_key="id")
    return conform(normalize_entries(placed, ingested_at), LADDER)


def ladder_outcomes(pages: DataFrame, apex: DataFrame) -> DataFrame:
    """One outcome per work item, for the resume plan."""
    columns = [*CELL, "page", "status", "retry_after", "entries"]
    return key_outcomes(pages.select(*columns).unionByName(apex.withColumn("page", F.lit(1)).select(*columns)), CELL)


def ladder_work(platforms: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Work items of a run, each with one text that names it; only the unfinished ones if outcomes are given."""
    grid = work_grid(platforms.select(F.col("id").alias("platform"), "region"))
    left = grid if outcomes is None else remaining(grid, outcomes, CELL)
    return left.withColumn("item", F.concat_ws("/", "platform", "tier", F.coalesce("division", F.lit("all"))))


def finished_cells(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The pages of the work items that were read to the end."""
    done = outcomes.where(is_done()).select(*[F.col(c).alias(f"_done_{c}") for c in CELL])
    same = [F.col(c).eqNullSafe(F.col(f"_done_{c}")) for c in CELL]
    return pages.join(done, same, "left_semi")


def collect_ladder(
    pages: DataFrame, apex: DataFrame, platforms: DataFrame, out: str, ingested_at, rows_per_file: int = 0
) -> DataFrame:
    """Write the ladder rows of the finished work items to ``out``; return the outcome of each item.

    An item is written whole, in the folder of its day, or not at all. A repeated run replaces its own rows, also by
    none where an item is empty now, and a resumed one adds the items that were left. Files grow to Spark's advised size unless ``rows_per_file`` is given.
    """
    outcomes = settle(ladder_outcomes(pages, apex), "ladder-outcomes")
    rows = ladder(finished_cells(pages, outcomes), finished_cells(apex, outcomes), platforms, ingested_at)
    dated = rows.withColumn(DAY, F.to_date("_ingested_at"))
    overwrite_partitions(dated, out, FOLDERS, rows_per_file)
    record_items(_finished_items(dated, outcomes, platforms, ingested_at), out, FOLDERS, ingested_at)
    clear_emptied(pages.sparkSession, out, LADDER_STORED, FOLDERS)
    return outcomes


def _finished_items(rows: DataFrame, outcomes: DataFrame, platforms: DataFrame, ingested_at) -> DataFrame:
    """The folder of each finished item, and whether it is ``empty``. Of the pages only the lists' sizes matter here."""
    done = lookup(outcomes.where(is_done()).select(*CELL), platforms, "platform", "region", dim_key="id")
    named = done.select(
        F.to_date(as_timestamp(ingested_at)).alias(DAY), "region", "platform", F.upper("tier").alias("tier"),
        F.coalesce(F.nullif("division", F.lit("")), F.lit("all")).alias("division"),
    )
    filled = rows.select(*FOLDERS, F.lit(False).alias("empty")).distinct()
    return named.distinct().join(filled, FOLDERS, "left").withColumn("empty", F.coalesce("empty", F.lit(True)))


def read_ladder(spark: SparkSession, path: str) -> DataFrame:
    """Stored ladder rows, without those of items that a later run of the day found empty."""
    return scan_items(spark, path, LADDER_STORED, FOLDERS)
