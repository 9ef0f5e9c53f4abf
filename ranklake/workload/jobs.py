"""The jobs from end to end, through their tables, and the user-function operator."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ranklake.functions import hashing
from ranklake.functions.dates import as_timestamp
from ranklake.operators import work
from ranklake.operators.normalize import classify, is_done
from ranklake.plans import ladder, match_ids, matches, players, suspend
from ranklake.schemas import DAY, LADDER, LADDER_STORED, MATCH_STATE, MATCHES, PLAYER_STATE
from ranklake.session import delete_path, scratch_path
from ranklake.sinks import tables
from ranklake.sources import parquet
from ranklake.workload import Registry
from ranklake.workload import inputs as I

query = Registry()


@query(
    f"""SELECT pos, queue, CASE queue WHEN 'error' THEN 'transient' WHEN 'signup' THEN 'not_found'
          WHEN 'view' THEN 'error' ELSE 'ok' END AS outcome,
        CAST(CASE queue WHEN 'error' THEN 5 ELSE 1 END AS INTEGER) AS attempts,
        CASE WHEN queue IN ('click', 'purchase') THEN match_id END AS match_id FROM ({I.ID_LIST})"""
)
def map_work(spark, sf_dir):
    """A function called once per item, or five times where the failure is transient."""

    def call(item):
        status = {"error": 500, "signup": 404, "view": 403}.get(item["queue"], 200)
        return status, None, [{"match_id": item["match_id"], "from_pos": item["pos"]}]

    schema = StructType().add("match_id", StringType()).add("from_pos", LongType())
    items = I.id_list(spark, sf_dir).select("pos", "queue", "match_id")
    records, outcomes = work.map_work(items, call, schema, ["pos", "queue"])
    return outcomes.select("pos", "queue", "outcome", "attempts").join(
        records.select(F.col("from_pos").alias("pos"), "match_id"), "pos", "left"
    )


_ENDS = f"""SELECT platform, tier, division, min(CASE WHEN highest < 0 AND lowest >= -900 THEN page END) AS empty_at,
          min(CASE WHEN lowest < -900 THEN page END) AS failed_at FROM ({I.PAGES}) GROUP BY ALL"""
_LADDER = f"""WITH e AS ({_ENDS}),
        r AS (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT {I.SQL_ENTRY_COLUMNS}, upper(p.tier) AS tier, p.division, r_name AS region, p.platform, {I.SQL_STAMP} AS _ingested_at
        FROM ({I.PAGE_ENTRIES}) p JOIN r ON n_name = p.platform
        LEFT JOIN e ON e.platform = p.platform AND e.tier = p.tier AND e.division = p.division
        WHERE c_acctbal >= 0 AND (empty_at IS NULL OR page < empty_at) AND (failed_at IS NULL OR failed_at > empty_at)
        UNION ALL
        SELECT s_name, '', '', CASE WHEN s_acctbal > 0 THEN CAST(floor(s_acctbal) AS INTEGER) ELSE 0 END, s_nationkey, 0,
          s_acctbal > 5000, false, false, false, 'CHALLENGER', 'all', r_name, r.n_name, {I.SQL_STAMP}
        FROM supplier JOIN nation n ON s_nationkey = n_nationkey JOIN r ON r.n_name = n.n_name"""


@query(_LADDER)
def ladder_job(spark, sf_dir):
    """Landed pages to the ladder table."""
    out = scratch_path(spark, "ladder")
    dim = I.nations(spark, sf_dir)
    ladder.collect_ladder(I.ladder_pages(spark, sf_dir), I.apex_pages(spark, sf_dir), dim, out, I.STAMP)
    return parquet.scan_table(spark, out, LADDER_STORED).drop(DAY)


def _half_written(spark, path):
    """Delete one file of a table, as if the job that wrote it had died on the way."""
    files = parquet.scan_table(spark, path, LADDER_STORED).select(F.input_file_name().alias("f")).distinct()
    delete_path(spark, files.orderBy("f").first()[0])


@query(_LADDER)
def ladder_job_repeated(spark, sf_dir):
    """The ladder job three times: the second finds a file of the first missing, the third finds all written."""
    out = scratch_path(spark, "ladder")
    dim = I.nations(spark, sf_dir)
    for again in range(3):
        ladder.collect_ladder(I.ladder_pages(spark, sf_dir), I.apex_pages(spark, sf_dir), dim, out, I.STAMP)
        if not again:
            _half_written(spark, out)
    return parquet.scan_table(spark, out, LADDER_STORED).drop(DAY)


@query(f"SELECT * FROM ({_LADDER}) WHERE platform NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 0)")
def ladder_job_emptied(spark, sf_dir):
    """The ladder job twice: the second finds the items of every other platform empty, and rows of the first go."""
    out, dim = scratch_path(spark, "ladder"), I.nations(spark, sf_dir)
    pages, apex = I.ladder_pages(spark, sf_dir), I.apex_pages(spark, sf_dir)
    ladder.collect_ladder(pages, apex, dim, out, I.STAMP)
    gone = I.table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("platform"), F.lit(True).alias("gone"))

    def without(landed):
        entries = F.when(F.col("gone"), F.array().cast(landed.schema["entries"].dataType)).otherwise(F.col("entries"))
        status = F.when(F.col("gone"), 200).otherwise(F.col("status"))
        return landed.join(gone, "platform", "left").withColumns({"entries": entries, "status": status}).select(*landed.columns)

    ladder.collect_ladder(without(pages), without(apex), dim, out, I.STAMP)
    return ladder.read_ladder(spark, out).drop(DAY)


@query(
    f"""SELECT platform, tier, division, CASE WHEN failed_at < coalesce(empty_at, 1e9) THEN 'transient' ELSE 'ok' END AS outcome
        FROM ({_ENDS})
        UNION ALL SELECT DISTINCT n_name, 'challenger', NULL, 'ok' FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def ladder_outcomes(spark, sf_dir):
    """What became of each work item of the ladder job."""
    found = ladder.ladder_outcomes(I.ladder_pages(spark, sf_dir), I.apex_pages(spark, sf_dir))
    return found.select("platform", "tier", "division", "outcome")


@query(
    f"""SELECT CAST(item AS VARCHAR) AS item, puuid, CASE WHEN {I.SQL_OUTCOME} IN ('ok', 'not_found') THEN 'first run'
          ELSE 'second run' END AS found_by FROM ({I.REPLIES})"""
)
def suspend_resume(spark, sf_dir):
    """A rate-limited run put aside and taken up: both runs together find every item once."""
    root = scratch_path(spark, "suspended")
    replies = I.replies(spark, sf_dir).withColumn("item", F.col("item").cast("string"))
    items, judged = replies.select("item", "puuid"), classify(replies)
    output = judged.where(is_done()).select("item", "puuid", F.lit("first run").alias("found_by"))
    suspend.put_aside(items, judged, output, root, "b", "job-1", I.STAMP, "item", ["item"])
    rest = suspend.take_up(items, root, "b", "job-1", "item")
    return suspend.with_earlier_output(rest.withColumn("found_by", F.lit("second run")), root, "b", "job-1")


_PLAN = f"""WITH b AS (SELECT puuid, region, platform FROM ({I.LADDER_ROWS})
          QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY {I.SQL_RANK}, tie) = 1)
        SELECT b.puuid, region, platform, last_read, {I.sql_shard("b.puuid")} AS shard_id
        FROM b LEFT JOIN ({I.PLAYER_STATE}) s ON b.puuid = s.puuid"""


@query(_PLAN)
def player_plan(spark, sf_dir):
    """Ladder rows to player state, as one plan."""
    return players.plan_players(I.ladder_rows(spark, sf_dir), I.player_state(spark, sf_dir), ties=["tie"])


def _ladder_table(spark, sf_dir):
    """The ladder rows as a stored ladder table. The division stands in as the tie break."""
    rows = I.ladder_rows(spark, sf_dir)
    fixed = {
        "division": F.lpad(F.col("tie").cast("string"), 20, "0"),
        "_ingested_at": as_timestamp(I.STAMP),
    }
    columns = [
        fixed.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LADDER
    ]
    path = scratch_path(spark, "ladder-table")
    tables.write_partitioned(rows.select(*columns), path, ["platform", "tier"])
    return path


def _seed_players(spark, sf_dir, root):
    seed = hashing.assign_shard(I.player_state(spark, sf_dir), "puuid").withColumns(
        {"region": F.lit("R"), "platform": F.lit("P")}
    )
    tables.write_state(tables.conform(seed, PLAYER_STATE), root, "2024-01-24")


@query(
    f"""WITH b AS (SELECT puuid, region, platform FROM ({I.LADDER_ROWS})
          QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY {I.SQL_RANK}, region, platform, tie) = 1)
        SELECT b.puuid, last_read, region, platform, {I.sql_shard("b.puuid")} AS shard_id
        FROM b LEFT JOIN ({I.PLAYER_STATE}) s ON b.puuid = s.puuid"""
)
def player_job(spark, sf_dir):
    """Ladder table and old player state to the new player state."""
    root = scratch_path(spark, "players")
    _seed_players(spark, sf_dir, root)
    players.run_players(spark, _ladder_table(spark, sf_dir), root, "2024-01-25")
    return tables.newest_state(spark, root, PLAYER_STATE)


# A player with a purchase above 100 was rate-limited; the others were read to the end.
def _player_outcomes(spark, sf_dir):
    limited = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    wait = F.max(F.when(limited, F.col("value")))
    return (
        I.table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("puuid"))
        .agg(
            F.when(F.bool_or(limited), "rate_limited").otherwise("ok").alias("outcome"),
            wait.alias("retry_after_seconds"),
        )
    )


_FINISHED = """SELECT CAST(user_id AS VARCHAR) AS puuid FROM events GROUP BY 1
 HAVING NOT bool_or(event_type = 'purchase' AND value > 100)"""
_NEW_IDS = f"""WITH s AS (SELECT * FROM ({I.PLAYER_STATE}) WHERE (last_read IS NULL OR last_read < {I.SQL_AS_OF})
          AND puuid IN ({_FINISHED})),
        l AS (SELECT i.puuid, pos, match_id, last_read FROM ({I.ID_LIST}) i JOIN s ON i.puuid = s.puuid
              WHERE queue = 'view' AND (last_read IS NULL
                OR game_start_timestamp >= epoch_ms(CAST(last_read AS TIMESTAMP)))),
        f AS (SELECT l.*, last_read IS NOT NULL AND (k.puuid IS NOT NULL
                OR row_number() OVER (PARTITION BY l.puuid, l.match_id ORDER BY pos) > 1) AS stop,
                k.puuid IS NOT NULL AS stored,
                row_number() OVER (PARTITION BY l.puuid ORDER BY pos) AS place
              FROM l LEFT JOIN ({I.KNOWN_IDS}) k ON l.puuid = k.puuid AND l.match_id = k.match_id),
        g AS (SELECT *, max(CAST(stop AS INTEGER)) OVER (PARTITION BY puuid ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM f)
        SELECT match_id, puuid, CAST(0 AS INTEGER) AS is_ingested, 'R' AS region, 'P' AS platform,
          {I.SQL_STAMP} AS _ingested_at, {I.sql_shard("puuid")} AS shard_id
        FROM g WHERE stopped = 0 AND place <= 1000 AND NOT stored"""


def _run_ids(spark, sf_dir, seeded=None):
    root, table = scratch_path(spark, "players"), seeded or scratch_path(spark, "match-ids")
    _seed_players(spark, sf_dir, root)
    stored = hashing.assign_shard(I.known_ids(spark, sf_dir), "puuid").withColumns(
        {
            "is_ingested": F.lit(1),
            "region": F.lit("R"),
            "platform": F.lit("P"),
            "_ingested_at": as_timestamp("2024-01-01T00:00:00"),
        }
    )
    stored = stored.withColumn(DAY, F.to_date("_ingested_at"))
    if not seeded:
        tables.append(tables.conform(stored, match_ids.STORED), table, match_ids.FOLDERS)
    ids = I.id_list(spark, sf_dir).withColumn("queue", F.when(F.col("queue") == "view", 420).otherwise(0))
    outcomes = _player_outcomes(spark, sf_dir)
    for run in ("2024-01-25", "2024-01-25"):  # the second run repeats the first and must add nothing
        match_ids.run_ids(spark, root, ids, outcomes, table, run, I.AS_OF, I.STAMP)
    return root, table


@query(_NEW_IDS)
def match_id_job(spark, sf_dir):
    """Player state and landed id lists to new match ids, run twice."""
    table = _run_ids(spark, sf_dir)[1]
    fresh = parquet.scan_table(spark, table, match_ids.STORED)
    return fresh.where(F.col("_ingested_at") == as_timestamp(I.STAMP)).drop(DAY)


@query(_NEW_IDS)
def match_id_job_half_written(spark, sf_dir):
    """The match-id job after an attempt that died half-way through its append, state not moved."""
    done = _run_ids(spark, sf_dir)[1]
    own = F.col("_ingested_at") == as_timestamp(I.STAMP)
    rows = parquet.scan_table(spark, done, match_ids.STORED)
    table = scratch_path(spark, "match-ids")
    tables.append(rows.where(~own | (F.xxhash64("puuid", "match_id") % 2 == 0)), table, match_ids.FOLDERS)
    _, table = _run_ids(spark, sf_dir, table)
    return parquet.scan_table(spark, table, match_ids.STORED).where(own).drop(DAY)


@query(
    f"""SELECT puuid, CASE WHEN (last_read IS NULL OR last_read < {I.SQL_AS_OF}) AND puuid IN ({_FINISHED})
          THEN {I.SQL_AS_OF} ELSE last_read END AS last_read FROM ({I.PLAYER_STATE})"""
)
def match_id_state(spark, sf_dir):
    """The read dates that the match-id job leaves behind."""
    root = _run_ids(spark, sf_dir)[0]
    return tables.newest_state(spark, root, PLAYER_STATE).select("puuid", "last_read")


# The listing table: one row per order and supplier.
_LISTED = """SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_suppkey AS VARCHAR) AS puuid,
 CAST(min(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS is_ingested,
 min(l_returnflag) AS region, min(l_returnflag) AS platform FROM lineitem GROUP BY 1, 2"""


def _listing_table(spark, sf_dir):
    path = scratch_path(spark, "listings")
    rows = (
        I.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("match_id"), F.col("l_suppkey").cast("string").alias("puuid"))
        .agg(
            F.min(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("is_ingested"),
            F.min("l_returnflag").alias("region"),
            F.min("l_returnflag").alias("platform"),
        )
        .withColumn("_ingested_at", as_timestamp(I.STAMP))
        .withColumn(DAY, F.to_date("_ingested_at"))
    )
    stored = tables.conform(hashing.assign_shard(rows, "puuid"), match_ids.STORED)
    tables.write_partitioned(stored, path, match_ids.FOLDERS)
    return path


@query(
    f"""SELECT match_id, puuid, is_ingested, region, platform, {I.sql_shard("match_id")} AS shard_id, true AS has_source
        FROM ({_LISTED})"""
)
def match_plan_job(spark, sf_dir):
    """Match-id listings to the match state, with the file each came from."""
    root = scratch_path(spark, "match-state")
    matches.run_plan_matches(spark, _listing_table(spark, sf_dir), root, "2024-01-25")
    rows = tables.newest_state(spark, root, MATCH_STATE)
    return rows.withColumn("has_source", F.col("source_file_path").endswith(".parquet")).drop("source_file_path")


def _run_matches(spark, sf_dir):
    listed, root = _listing_table(spark, sf_dir), scratch_path(spark, "match-state")
    table = scratch_path(spark, "matches")
    matches.run_plan_matches(spark, listed, root, "2024-01-25")
    matches.run_matches(spark, root, I.match_replies(spark, sf_dir), table, listed, "2024-01-26", I.STAMP)
    return listed, root, table


_PENDING = f"""SELECT match_id, min((region, platform)) AS place FROM ({_LISTED}) WHERE is_ingested = 0 GROUP BY 1"""


@query(
    f"""SELECT p.match_id, {I.sql_match_columns("date_trunc('month', o_orderdate)")}, place[1] AS region, place[2] AS platform,
          CAST(year(make_timestamp(ms * 1000)) AS INTEGER) AS year, CAST(month(make_timestamp(ms * 1000)) AS INTEGER) AS month,
          CAST(day(make_timestamp(ms * 1000)) AS INTEGER) AS date
        FROM ({_PENDING}) p
        JOIN (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE epoch_us(date_trunc('month', o_orderdate)) // 1000 END AS ms FROM orders)
          ON CAST(o_orderkey AS VARCHAR) = p.match_id
        WHERE o_orderstatus <> 'O'"""
)
def match_job(spark, sf_dir):
    """Pending matches and their replies to the match table."""
    table = _run_matches(spark, sf_dir)[2]
    schema = StructType([*MATCHES.fields]).add("year", "integer").add("month", "integer").add("date", "integer")
    return parquet.scan_table(spark, table, schema)


_FLAGGED = f"""SELECT match_id, puuid, CASE WHEN match_id IN (SELECT match_id FROM ({_PENDING}))
 AND match_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders) THEN 1 ELSE is_ingested END AS is_ingested FROM ({_LISTED})"""


@query(_FLAGGED)
def match_job_listings(spark, sf_dir):
    """The flags that the match job leaves in the listing table."""
    listed = _run_matches(spark, sf_dir)[0]
    return parquet.scan_table(spark, listed, match_ids.STORED).select("match_id", "puuid", "is_ingested")


@query(_FLAGGED)
def match_job_state(spark, sf_dir):
    """The flags that the match job leaves in the match state."""
    root = _run_matches(spark, sf_dir)[1]
    return tables.newest_state(spark, root, MATCH_STATE).select("match_id", "puuid", "is_ingested")


def _run_matches_logged(spark, sf_dir):
    """The match job beside a table and a state that it does not rewrite."""
    listed, root = _listing_table(spark, sf_dir), scratch_path(spark, "match-state")
    table = scratch_path(spark, "matches")
    matches.run_plan_matches(spark, listed, root, "2024-01-25", log=True)
    matches.run_matches(spark, root, I.match_replies(spark, sf_dir), table, listed, "2024-01-26", I.STAMP, log=True)
    return listed, root


@query(_FLAGGED)
def match_job_overlay(spark, sf_dir):
    """The flags that the match job leaves beside the listing table, read together with it."""
    listed = _run_matches_logged(spark, sf_dir)[0]
    return matches.read_listings(spark, listed).select("match_id", "puuid", "is_ingested")


@query(_FLAGGED)
def match_job_compacted(spark, sf_dir):
    """The listing table itself, once the flags are folded into it."""
    listed, root = _run_matches_logged(spark, sf_dir)
    matches.compact_matches(spark, root, listed, "2024-01-27")
    return parquet.scan_table(spark, listed, match_ids.STORED).select("match_id", "puuid", "is_ingested")


@query(_FLAGGED)
def match_job_log(spark, sf_dir):
    """The match state as base and log."""
    root = _run_matches_logged(spark, sf_dir)[1]
    return matches.read_match_state(spark, root).select("match_id", "puuid", "is_ingested")


@query(
    f"""SELECT match_id, puuid, is_ingested, region, platform, {I.sql_shard("match_id")} AS shard_id FROM ({_LISTED})"""
)
def match_plan_log(spark, sf_dir):
    """Listings that arrive on two days, planned day by day, the first day's compacted in between."""
    whole, root, listed = _listing_table(spark, sf_dir), scratch_path(spark, "match-state"), scratch_path(spark, "listings")
    rows = parquet.scan_table(spark, whole, match_ids.STORED)
    for day, stamp in enumerate(("2024-01-25T00:00:00", "2024-01-26T00:00:00")):
        part = rows.where(F.pmod(F.xxhash64("match_id", "puuid"), F.lit(2)) == day).withColumn("_ingested_at", as_timestamp(stamp))
        tables.append(part.withColumn(DAY, F.to_date("_ingested_at")), listed, match_ids.FOLDERS)
        matches.run_plan_matches(spark, listed, root, f"2024-01-2{5 + day}", log=True)
        if not day:
            matches.compact_matches(spark, root, listed, "2024-01-25b")
    return matches.read_match_state(spark, root).drop("source_file_path")
