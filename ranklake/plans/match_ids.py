"""Player state and landed id lists to new match ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.dates import as_date, as_timestamp
from ranklake.functions.hashing import assign_shard
from ranklake.operators.filters import due, is_due
from ranklake.operators.increment import increment
from ranklake.operators.joins import existing_keys, remaining
from ranklake.operators.normalize import id_records, is_done, outcome
from ranklake.operators.summary import RunCounts, resume_plan
from ranklake.operators.work import advance, map_work
from ranklake.schemas import DAY, IDS_PER_PLAYER, MATCH_IDS, PLAYER_STATE, SHARDS
from ranklake.session import settle
from ranklake.sinks import journal
from ranklake.sinks.tables import append, conform, newest_state, write_state
from ranklake.sources.pages import explode_ids, key_outcomes, pages_before_stop
from ranklake.sources.parquet import last_shard_wins, scan_table

FOLDERS = [DAY, "region", "platform", "shard_id"]
STORED = StructType([*MATCH_IDS.fields]).add("shard_id", "integer").add(DAY, "date")


LISTED = StructType().add("pos", "long").add("match_id", "string").add("queue", "integer").add(
    "game_start_timestamp", "long"
)


def fetch_ids(state: DataFrame, fn: Callable, as_of, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Id lists and outcomes from a function that gets a due player and returns status, retry-after and ids.

    Each id is a dict with the columns of ``LISTED``.
    """
    return map_work(due(state, as_of), fn, LISTED, ["puuid"], parts)


def new_ids(
    state: DataFrame, ids: DataFrame, known: DataFrame, outcomes: DataFrame, as_of, ingested_at, cap: int = IDS_PER_PLAYER
) -> DataFrame:
    """Match-id rows of the players that were read to the end.

    ``ids`` has one row per listed id (``puuid, pos, match_id, queue, game_start_timestamp``),
    ``known`` the stored ``puuid, match_id``, ``outcomes`` one outcome per player.
    """
    finished = due(state, as_of).join(
        outcomes.where(F.col("outcome").isin("ok", "not_found")).select("puuid"), "puuid", "left_semi"
    )
    return id_records(increment(ids, finished, known, as_of, cap=cap), ingested_at)


def run_ids(
    spark: SparkSession,
    state_root: str,
    ids: DataFrame,
    outcomes: DataFrame,
    table: str,
    run: str,
    as_of,
    ingested_at,
    shards: int = SHARDS,
    cap: int = IDS_PER_PLAYER,
    counts: RunCounts | None = None,
) -> DataFrame:
    """Append the new ids to ``table``, advance the read dates, and return the resume plan.

    Rows are appended before the state moves on. If the run stops in between, even half-way through
    the append, running it again with the same ``ingested_at`` adds what is missing and nothing twice: rows of
    that stamp do not end a list, and rows that are stored already are left out.

    ``counts`` takes the run's counts: ``outcomes`` (those ``done`` too), ``new`` ids, and the ``state`` (rows still ``due`` too).
    """
    counts = counts or RunCounts()
    journal.recover(spark, table)
    state = last_shard_wins(newest_state(spark, state_root, PLAYER_STATE, run), "puuid")
    outcomes = settle(counts.at("outcomes", done=F.count_if(is_done()))(outcomes), "id-outcomes")
    readers = due(state, as_of).join(outcomes.where(is_done()).select("puuid"), "puuid", "left_semi")
    own = F.col("_ingested_at").eqNullSafe(as_timestamp(ingested_at)).alias("_own")
    pairs = scan_table(spark, table, STORED).select("puuid", "match_id", own)
    stored = settle(existing_keys(pairs, readers, ["puuid"], ["puuid", "match_id", "_own"]), "stored-ids")
    known = stored.where("not _own").select("puuid", "match_id")
    fresh = new_ids(state, ids, known, outcomes, as_of, ingested_at, cap)
    held = stored.select("puuid", "match_id").distinct()
    fresh = fresh.join(held, ["puuid", "match_id"], "left_anti").select(*fresh.columns)
    rows = assign_shard(conform(fresh, MATCH_IDS), "puuid", shards).withColumn(DAY, F.to_date("_ingested_at"))
    sorted_rows = rows.hint("rebalance", *FOLDERS).sortWithinPartitions(*FOLDERS, "puuid")
    append(counts.at("new")(sorted_rows), table, FOLDERS)
    read_now = F.when(is_due(as_of), as_date(as_of)).otherwise(F.col("last_read"))
    moved = advance(state, outcomes, "puuid", {"last_read": read_now})
    write_state(conform(moved, PLAYER_STATE), state_root, run, seen=counts.at("state", due=F.count_if(is_due(as_of))))
    return resume_plan(outcomes)


def listed_ids(pages: DataFrame) -> DataFrame:
    """Landed id pages (``puuid, queue, start, ids, status, retry_after``) as id lists: what comes before the first empty or failed page.

    Ids without a start time count from the beginning: ``game_start_timestamp`` is passed on if the pages have it.
    """
    stop = (F.coalesce(F.size("ids"), F.lit(0)) <= 0) | (outcome("status") != "ok")
    read = explode_ids(pages_before_stop(pages, ["puuid", "queue"], "start", stop))
    times = [] if "game_start_timestamp" in read.columns else [F.lit(None).cast("long").alias("game_start_timestamp")]
    return read.select("puuid", "pos", "match_id", "queue", *(times or ["game_start_timestamp"]))


def page_outcomes(pages: DataFrame) -> DataFrame:
    """One outcome per player from landed id pages, for ``run_ids``: that of the first page that failed."""
    found = key_outcomes(pages, ["puuid", "queue"], "start", "ids")
    failed = F.col("outcome") != "ok"
    return found.groupBy("puuid").agg(
        F.coalesce(F.min(F.when(failed, F.col("outcome"))), F.lit("ok")).alias("outcome"),
        F.max("retry_after_seconds").alias("retry_after_seconds"),
    )


def left_over(state: DataFrame, outcomes: DataFrame, as_of) -> DataFrame:
    """Players that are due and not finished."""
    return remaining(due(state, as_of), outcomes, ["puuid"])
