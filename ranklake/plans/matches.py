"""Match-id listings to match details, and the flags that go back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ranklake.functions.dates import as_timestamp, with_partition_date
from ranklake.functions.hashing import assign_shard
from ranklake.operators.dedup import best_per_key
from ranklake.operators.filters import pending, valid_key
from ranklake.operators.joins import new_files
from ranklake.operators.normalize import classify, is_done, normalize_match, parse_match
from ranklake.operators.numbering import rows_per_file
from ranklake.operators.propagate import last_listings, propagate
from ranklake.operators.summary import RunCounts, resume_plan, shard_counts
from ranklake.operators.work import advance, map_work
from ranklake.plans.match_ids import FOLDERS as LISTING_FOLDERS
from ranklake.plans.match_ids import STORED
from ranklake.schemas import FLUSH_BYTES, MATCH_REPLIES, MATCH_STATE, MATCHES, SHARDS
from ranklake.session import path_exists, settle
from ranklake.sinks import journal, overlay, statelog
from ranklake.sinks.tables import conform, newest_state, write_partitioned, write_state
from ranklake.sources.files import list_files
from ranklake.sources.parquet import fill_defaults, scan_files, scan_table, scan_with_source

FOLDERS = ["region", "platform", "year", "month", "date"]
DAYS = ("year", "month", "date")


def plan_matches(listings: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All listings with a match id, flag defaulted to 0, and the shard of the id."""
    rows = fill_defaults(valid_key(listings, "match_id"), {"is_ingested": 0})
    return assign_shard(rows, "match_id", shards)


def run_plan_matches(
    spark: SparkSession, table: str, state_root: str, run: str, shards: int = SHARDS, log: bool = False
) -> DataFrame:
    """Write the match state of ``run`` and return its rows per shard.

    With ``log`` the run opens only listing files that no earlier run has read, and writes their rows beside the state.
    """
    journal.recover(spark, table)
    if log:
        _plan_new(spark, table, state_root, run, shards)
        return shard_counts(read_match_state(spark, state_root), shards)
    listings = scan_with_source(spark, table, STORED, partitioned=True).drop("shard_id")
    path = write_state(conform(plan_matches(listings, shards), MATCH_STATE), state_root, run)
    return shard_counts(scan_table(spark, path, MATCH_STATE), shards)


_STATE_KEY = ["match_id", "puuid"]


def read_match_state(spark: SparkSession, state_root: str, before: str | None = None) -> DataFrame:
    """The match state with all that runs have written beside it."""
    return statelog.read_state(spark, state_root, MATCH_STATE, "match_id", ["puuid", "source_file_path"], before)


def _plan_new(spark: SparkSession, table: str, state_root: str, run: str, shards: int) -> None:
    earlier = statelog.files_read(spark, state_root, run)
    mark = earlier.agg(F.max("newest")).first()[0]
    listed = list_files(spark, table).select("file_path") if path_exists(spark, table) else earlier.select("file_path")
    fresh = settle(new_files(listed, earlier), "new-listings")
    listings = scan_files(spark, table, [r.file_path for r in fresh.collect()], STORED)  # the files since the last plan
    if mark is not None:
        # Rows that a compaction moved to new files are planned already; so may be rows of a run that was repeated.
        old = F.col("_ingested_at").isNull() | (F.col("_ingested_at") <= F.lit(mark))
        again = settle(listings.where(old), "old-listings")
        if not again.isEmpty():
            known = read_match_state(spark, state_root, run).select(*_STATE_KEY)
            again = again.join(known, _STATE_KEY, "left_anti").select(*listings.columns)
        listings = listings.where(~old).unionByName(again)
    rows = plan_matches(listings.drop("shard_id"), shards)
    statelog.write_delta(conform(rows, MATCH_STATE), state_root, run)
    newest = listings.groupBy(F.col("source_file_path").alias("file_path")).agg(F.max("_ingested_at").alias("newest"))
    statelog.write_files(fresh.join(newest, "file_path", "left"), state_root, run)


def match_work(state: DataFrame) -> DataFrame:
    """Pending match ids, each once."""
    place = F.min(F.struct("region", "platform")).alias("_place")
    return pending(state).groupBy("match_id").agg(place).select("match_id", "_place.region", "_place.platform")


def fetch_replies(work: DataFrame, fn: Callable, parts: int | None = None) -> DataFrame:
    """Replies from a function that gets a work item and returns status, retry-after and ``[{"body": text}]``.

    Items that a rate-limited part left untouched have no reply and stay pending.
    """
    bodies, outcomes = map_work(work, fn, StructType().add("body", "string"), ["match_id"], parts)
    tried = outcomes.where("attempts > 0").withColumn(
        "status", F.when(F.col("failure").isNotNull(), 400).otherwise(F.col("status"))
    )
    return conform(tried.join(bodies, "match_id", "left"), MATCH_REPLIES)


def judge_replies(work: DataFrame, replies: DataFrame) -> DataFrame:
    """Work items with their reply, parsed, and its outcome. A reply that is no JSON object is an error.

    Of several replies to one item, the one with the lowest status counts. An item without a reply is pending.
    """
    one = best_per_key(replies, ["match_id"], [F.asc_nulls_last("status"), "body"])
    one = one.select("match_id", "status", "retry_after", "body", F.lit(True).alias("_replied"))
    judged = parse_match(classify(work.join(one, "match_id", "left")))
    broken = F.col("body").isNull() | F.col("_doc._broken").isNotNull()
    outcome = (
        F.when(F.col("_replied").isNull(), "pending")
        .when((F.col("outcome") == "ok") & broken, "error")
        .otherwise(F.col("outcome"))
    )
    return judged.withColumn("outcome", outcome).drop("body", "_replied")


def match_rows(judged: DataFrame, ingested_at) -> DataFrame:
    """Match rows with their partition date, from the replies that succeeded."""
    rows = conform(normalize_match(judged.where("outcome = 'ok'"), ingested_at), MATCHES)
    return with_partition_date(rows, "game_start_timestamp")


def run_matches(
    spark: SparkSession,
    state_root: str,
    replies: DataFrame,
    table: str,
    listings_table: str,
    run: str,
    ingested_at,
    scope: str = "all",
    log: bool = False,
    counts: RunCounts | None = None,
) -> DataFrame:
    """Append match rows, flag state and listings, and return the resume plan.

    ``scope`` is ``all`` to flag every listing of a finished match, or ``last`` to flag only
    those in the file that lists it last. If the run stops in between, running it again adds
    no match twice: the ids that are stored already are left out.

    With ``log`` no old file is rewritten: the flags are written beside the listings (``read_listings`` sees them) and
    the finished ids beside the state, until ``compact_matches`` folds them in.

    ``counts`` takes the pending matches of the run (``work``; those ``done`` and ``ok`` too), the ``new`` rows and, without ``log``,
    those of the ``state`` (``finished`` ones too).
    """
    counts = counts or RunCounts()
    journal.recover(spark, listings_table)
    state = read_match_state(spark, state_root, run) if log else newest_state(spark, state_root, MATCH_STATE, run)
    judged = judge_replies(match_work(state), conform(replies, MATCH_REPLIES))
    kinds = {"done": F.count_if(is_done()), "ok": F.count_if(F.col("outcome") == "ok")}
    judged = settle(counts.at("work", **kinds)(judged), "match-replies")
    rows = match_rows(judged, ingested_at)
    # A match is stored under its day, so only the days of the new rows are read.
    dated = StructType([*MATCHES.fields])
    for part in DAYS:
        dated = dated.add(part, "integer")
    days = settle(rows.select(*DAYS).distinct(), "match-days")
    known = scan_table(spark, table, dated).select("match_id", *DAYS).join(days, list(DAYS), "left_semi")
    rows = rows.join(known, ["match_id", *DAYS], "left_anti").select(*rows.columns)
    write_partitioned(rows, table, FOLDERS, rows_per_file(FLUSH_BYTES["matches"]), seen=counts.at("new"))
    done = judged.where(is_done()).select("match_id")
    order = ["source_file_path", "source_row"] if scope == "last" else []
    if log:
        flags = done
        if scope == "last":
            listings = journal.scan_published(spark, listings_table, STORED)
            flags = last_listings(listings, done, "match_id", order, order)
        day = spark.range(1).select(F.to_date(as_timestamp(ingested_at))).first()[0]
        overlay.write_flags(flags, listings_table, "match_id", day, run, ingested_at, scope)
        statelog.write_done(done, state_root, run)
    else:
        if scope == "last":
            listings = scan_with_source(spark, listings_table, STORED, partitioned=True)
        else:
            listings = scan_table(spark, listings_table, STORED)
        propagate(listings, done, listings_table, "match_id", LISTING_FOLDERS, ["puuid"], scope, order)
        moved = advance(state, judged, "match_id", {"is_ingested": 1}, ["puuid", "source_file_path"])
        finished = counts.at("state", finished=F.count_if(F.col("is_ingested") == 1))
        write_state(conform(moved, MATCH_STATE), state_root, run, seen=finished)
    plan = resume_plan(judged)
    return spark.createDataFrame([plan.first()], plan.schema)


def read_listings(spark: SparkSession, table: str) -> DataFrame:
    """Match-id listings with their flags as of now, and the file and place each came from."""
    return overlay.read_flagged(spark, table, STORED, "match_id", ["puuid"])


def compact_matches(spark: SparkSession, state_root: str, listings_table: str, run: str) -> int:
    """Fold what runs with ``log`` have written into listings and state; return how many runs' flags were folded.

    ``run`` names the new state. A death on the way loses nothing; calling it again goes on.
    """
    folded = overlay.compact(spark, listings_table, STORED, "match_id", LISTING_FOLDERS, ["puuid"])
    statelog.compact_state(spark, state_root, MATCH_STATE, "match_id", ["puuid", "source_file_path"], run)
    statelog.drop_compacted(spark, state_root)
    return folded
