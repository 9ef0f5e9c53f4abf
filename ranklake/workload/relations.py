"""Joins, grouping and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklake.functions import hashing
from ranklake.functions.text import tier_rank
from ranklake.operators import chunks, dedup, grid, joins, numbering, propagate, summary, work
from ranklake.operators.increment import increment as new_part
from ranklake.operators.increment import take_until_seen as until_seen
from ranklake.operators.normalize import classify
from ranklake.sources import parquet
from ranklake.workload import Registry
from ranklake.workload import inputs as I

query = Registry()


@query(
    """WITH cells AS (
          SELECT t AS tier, CAST(NULL AS VARCHAR) AS division FROM (SELECT unnest(['MACHINERY', 'FURNITURE']) AS t)
          UNION ALL
          SELECT t, d FROM (SELECT unnest(['BUILDING', 'AUTOMOBILE', 'HOUSEHOLD']) AS t),
                           (SELECT unnest(['I', 'II', 'III', 'IV']) AS d)),
        seen AS (SELECT n_name AS platform, c_mktsegment AS tier,
            CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN NULL
                 WHEN c_acctbal > 4000 THEN 'I' ELSE 'II' END AS division, count(*) AS players
          FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
        SELECT n_name AS platform, c.tier, coalesce(c.division, 'all') AS division, coalesce(players, 0) AS players
        FROM (SELECT DISTINCT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
        JOIN cells c ON true
        LEFT JOIN seen s ON s.platform = n_name AND s.tier = c.tier AND s.division IS NOT DISTINCT FROM c.division"""
)
def work_grid(spark, sf_dir):
    """Players per work item, for every platform that has players."""
    apex = ["MACHINERY", "FURNITURE"]
    placed = I.customers_placed(spark, sf_dir).select(
        "platform", "tier", F.when(F.col("tier").isin(apex), "all").otherwise(F.col("division")).alias("division")
    )
    seen = placed.groupBy("platform", "tier", "division").agg(F.count("*").alias("players"))
    items = grid.work_grid(
        seen.select("platform").distinct(), ["BUILDING", "AUTOMOBILE", "HOUSEHOLD"], apex, ["I", "II", "III", "IV"]
    ).withColumn("division", F.coalesce("division", F.lit("all")))
    return items.join(seen, ["platform", "tier", "division"], "left").withColumn(
        "players", F.coalesce("players", F.lit(0))
    )


@query(
    """SELECT c_custkey, n_name AS platform, r_name AS region, coalesce(CASE WHEN r_name <> 'ASIA' THEN r_name END, '') AS lenient
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def lookup_region(spark, sf_dir):
    rows = I.customers_placed(spark, sf_dir).select("c_custkey", "platform")
    dim = I.nations(spark, sf_dir)
    strict = joins.lookup(rows, dim, "platform", "region", dim_key="id")
    partial = dim.where("region <> 'ASIA'").withColumnRenamed("region", "lenient")
    return joins.lookup(strict, partial, "platform", "lenient", dim_key="id", strict=False)


@query(f"SELECT puuid, last_read FROM ({I.CURRENT_PLAYERS}) LEFT JOIN ({I.PLAYER_STATE}) USING (puuid)")
def merge_state(spark, sf_dir):
    return joins.merge_state(I.current_players(spark, sf_dir), I.player_state(spark, sf_dir), "puuid")


@query(f"SELECT * FROM ({I.PLAYER_STATE}) WHERE puuid NOT IN (SELECT puuid FROM ({I.CURRENT_PLAYERS}))")
def departed_keys(spark, sf_dir):
    return joins.departed(I.current_players(spark, sf_dir), I.player_state(spark, sf_dir), "puuid")


@query(f"SELECT * FROM ({I.CURRENT_PLAYERS}) WHERE puuid NOT IN (SELECT puuid FROM ({I.PLAYER_STATE}))")
def arrived_keys(spark, sf_dir):
    return joins.arrived(I.current_players(spark, sf_dir), I.player_state(spark, sf_dir), "puuid")


@query(
    f"""SELECT i.puuid, pos, i.match_id, k.puuid IS NOT NULL AS known FROM ({I.ID_LIST}) i
        LEFT JOIN ({I.KNOWN_IDS}) k ON i.puuid = k.puuid AND i.match_id = k.match_id"""
)
def flag_known(spark, sf_dir):
    ids = I.id_list(spark, sf_dir).select("puuid", "pos", "match_id")
    return joins.flag_known(ids, I.known_ids(spark, sf_dir), ["puuid", "match_id"], ["pos"])


@query(
    f"""SELECT DISTINCT puuid, match_id FROM ({I.ID_LIST})
        WHERE puuid IN (SELECT puuid FROM ({I.PLAYER_STATE}) WHERE last_read < {I.SQL_AS_OF})"""
)
def existing_keys(spark, sf_dir):
    wanted = I.player_state(spark, sf_dir).where(F.col("last_read") < F.lit(I.AS_OF).cast("date"))
    return joins.existing_keys(I.id_list(spark, sf_dir), wanted, ["puuid"], ["puuid", "match_id"])


@query(
    f"""SELECT match_id, puuid, part, line,
        CASE WHEN match_id IN (SELECT match_id FROM ({I.DONE_MATCHES})) THEN 1 ELSE is_ingested END AS is_ingested
        FROM ({I.LISTINGS})"""
)
def mark_done(spark, sf_dir):
    rows = I.listings(spark, sf_dir).select("match_id", "puuid", "part", "line", "is_ingested")
    return joins.mark(rows, I.done_matches(spark, sf_dir), "match_id", {"is_ingested": 1}, I.SPREAD)


@query(
    f"""WITH l AS ({I.LISTINGS}), d AS ({I.DONE_MATCHES})
        SELECT match_id, puuid, part, line, source_file_path,
          CASE WHEN match_id IN (FROM d) THEN 1 ELSE is_ingested END AS is_ingested
        FROM l WHERE source_file_path IN
          (SELECT source_file_path FROM l WHERE match_id IN (FROM d) AND is_ingested IS DISTINCT FROM 1)"""
)
def propagate_all(spark, sf_dir):
    rows, done = I.listings(spark, sf_dir), I.done_matches(spark, sf_dir)
    return propagate.flag_touched(rows, done, "match_id", ["source_file_path"], I.SPREAD)


@query(
    f"""WITH l AS ({I.LISTINGS}), d AS ({I.DONE_MATCHES}),
        last AS (SELECT match_id, max(source_file_path) AS source_file_path FROM l WHERE match_id IN (FROM d) GROUP BY 1)
        SELECT match_id, puuid, part, line, source_file_path,
          CASE WHEN (match_id, source_file_path) IN (FROM last) THEN 1 ELSE is_ingested END AS is_ingested
        FROM l"""
)
def propagate_last(spark, sf_dir):
    return propagate.flag_listings(
        I.listings(spark, sf_dir),
        I.done_matches(spark, sf_dir),
        "match_id",
        I.SPREAD,
        scope="last",
        order=["source_file_path", "puuid", "part", "line"],
    )


@query(
    """SELECT DISTINCT source || '/' || lang AS file_path FROM documents
        EXCEPT SELECT source || '/' || lang FROM documents WHERE lang = 'en' OR n_chars > 5000"""
)
def new_files(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang").alias("file_path")
    ledger = docs.where("lang = 'en' OR n_chars > 5000").select(path).distinct()
    return joins.new_files(docs.select(path).distinct(), ledger)


@query(
    f"""SELECT item, puuid FROM ({I.REPLIES})
        WHERE item NOT IN (SELECT item FROM ({I.REPLIES}) WHERE {I.SQL_OUTCOME} IN ('ok', 'not_found'))"""
)
def remaining_work(spark, sf_dir):
    replies = I.replies(spark, sf_dir)
    return joins.remaining(replies.select("item", "puuid"), classify(replies), ["item"])


@query(
    f"""SELECT puuid, CASE WHEN puuid IN (SELECT puuid FROM ({I.REPLIES}) GROUP BY puuid
          HAVING bool_and({I.SQL_OUTCOME} NOT IN ('error', 'transient')) OR count(*) < 60)
          THEN {I.SQL_AS_OF} ELSE last_read END AS last_read
        FROM ({I.PLAYER_STATE})"""
)
def advance_state(spark, sf_dir):
    """A player is done when no reply of it failed, or it has few of them."""
    judged = classify(I.replies(spark, sf_dir))
    failed = F.bool_or(F.col("outcome").isin("error", "transient")) & (F.count("*") >= 60)
    outcomes = judged.groupBy("puuid").agg(F.when(failed, "error").otherwise("ok").alias("outcome"))
    state = I.player_state(spark, sf_dir)
    return work.advance(state, outcomes, "puuid", {"last_read": F.lit(I.AS_OF).cast("date")})


@query(f"SELECT s AS shard_id, count(puuid) AS rows FROM (SELECT CAST(range AS INTEGER) AS s FROM range(64)) LEFT JOIN (SELECT puuid, {I.sql_shard('puuid', 64)} AS shard_id FROM ({I.PLAYER_STATE})) ON s = shard_id GROUP BY s")
def shard_counts(spark, sf_dir):
    return summary.shard_counts(hashing.assign_shard(I.player_state(spark, sf_dir), "puuid", 64), 64)


@query(f"SELECT DISTINCT match_id FROM ({I.LISTINGS})")
def distinct_keys(spark, sf_dir):
    return dedup.distinct_keys(I.listings(spark, sf_dir), "match_id")


@query(f"SELECT source_file_path, count(DISTINCT match_id) AS ids FROM ({I.LISTINGS}) GROUP BY 1")
def ids_by_source(spark, sf_dir):
    return summary.source_counts(I.listings(spark, sf_dir))


@query(
    """SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows
        FROM lineitem GROUP BY ALL"""
)
def partition_counts(spark, sf_dir):
    rows = I.table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return summary.partition_counts(rows, ["l_returnflag", "l_linestatus", "year"])


_BEST = f"""SELECT puuid, tier, region, platform, tie FROM ({I.LADDER_ROWS})
 QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY {I.SQL_RANK}, tie) = 1"""


@query(_BEST)
def dedup_best(spark, sf_dir):
    return dedup.dedup_best(I.ladder_rows(spark, sf_dir), "puuid", ties=["tie"])


@query(_BEST)
def best_by_agg(spark, sf_dir):
    ranked = I.ladder_rows(spark, sf_dir).withColumn("rank", tier_rank("tier"))
    return dedup.best_by(ranked, ["puuid"], ["rank", "tie"]).drop("rank")


@query(
    f"""SELECT match_id, puuid, part, line, source_file_path FROM ({I.LISTINGS})
        QUALIFY row_number() OVER (PARTITION BY match_id
          ORDER BY source_file_path DESC, puuid DESC, part DESC, line DESC) = 1"""
)
def latest_listing(spark, sf_dir):
    order = ["source_file_path", "puuid", "part", "line"]
    return dedup.latest_by(I.listings(spark, sf_dir).select("match_id", *order), ["match_id"], order)


@query(
    f"""SELECT puuid, tie, shard FROM (SELECT puuid, tie, {I.sql_shard("CAST(tie AS VARCHAR)")} AS shard FROM ({I.LADDER_ROWS}))
        QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY shard DESC, tie DESC) = 1"""
)
def state_last_wins(spark, sf_dir):
    """Players stored in several shards: the row of the highest shard wins."""
    rows = hashing.assign_shard(I.ladder_rows(spark, sf_dir), "tie").select("puuid", "tie", "shard_id")
    newest = rows.groupBy("puuid", "shard_id").agg(F.max("tie").alias("tie"))
    return parquet.last_shard_wins(newest, "puuid").select("puuid", "tie", F.col("shard_id").alias("shard"))


_UNTIL = """WITH l AS ({list}), k AS ({known}),
 f AS (SELECT l.puuid, pos, l.match_id, k.puuid IS NOT NULL
          OR row_number() OVER (PARTITION BY l.puuid, l.match_id ORDER BY pos) > 1 AS stop,
          row_number() OVER (PARTITION BY l.puuid ORDER BY pos) AS place
       FROM l LEFT JOIN k ON l.puuid = k.puuid AND l.match_id = k.match_id),
 g AS (SELECT *, max(CAST(stop AS INTEGER)) OVER (PARTITION BY puuid ORDER BY pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM f)
 SELECT puuid, pos, match_id FROM g WHERE stopped = 0 AND place <= {cap}"""


@query(_UNTIL.format(list=I.ID_LIST, known=I.KNOWN_IDS, cap=1000))
def take_until_seen(spark, sf_dir):
    ids = I.id_list(spark, sf_dir).select("puuid", "pos", "match_id")
    return until_seen(ids, "puuid", "pos", "match_id", I.known_ids(spark, sf_dir))


@query(_UNTIL.format(list=I.ID_LIST, known=I.KNOWN_IDS, cap=5))
def take_until_seen_capped(spark, sf_dir):
    ids = I.id_list(spark, sf_dir).select("puuid", "pos", "match_id")
    return until_seen(ids, "puuid", "pos", "match_id", I.known_ids(spark, sf_dir), cap=5)


@query(
    f"""SELECT puuid, pos, match_id FROM ({I.ID_LIST})
        QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY pos) <= 20"""
)
def cap_per_key(spark, sf_dir):
    ids = I.id_list(spark, sf_dir).select("puuid", "pos", "match_id")
    return dedup.cap_per_key(ids, ["puuid"], ["pos"], 20)


@query(
    f"""WITH s AS (SELECT * FROM ({I.PLAYER_STATE}) WHERE last_read IS NULL OR last_read < {I.SQL_AS_OF}),
        l AS (SELECT i.puuid, pos, match_id, last_read FROM ({I.ID_LIST}) i JOIN s ON i.puuid = s.puuid
              WHERE queue = 'view' AND (last_read IS NULL
                OR game_start_timestamp >= epoch_ms(CAST(last_read AS TIMESTAMP)))),
        f AS (SELECT l.*, last_read IS NOT NULL AND (k.puuid IS NOT NULL
                OR row_number() OVER (PARTITION BY l.puuid, l.match_id ORDER BY pos) > 1) AS stop,
                row_number() OVER (PARTITION BY l.puuid ORDER BY pos) AS place
              FROM l LEFT JOIN ({I.KNOWN_IDS}) k ON l.puuid = k.puuid AND l.match_id = k.match_id),
        g AS (SELECT *, max(CAST(stop AS INTEGER)) OVER (PARTITION BY puuid ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM f)
        SELECT puuid, pos, match_id, last_read FROM g WHERE stopped = 0 AND place <= 8"""
)
def increment(spark, sf_dir):
    found = new_part(
        I.id_list(spark, sf_dir),
        I.player_state(spark, sf_dir),
        I.known_ids(spark, sf_dir),
        I.AS_OF,
        cap=8,
        queue="view",
    )
    return found.select("puuid", "pos", "match_id", "last_read")


@query("SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS part FROM orders")
def split_even(spark, sf_dir):
    return numbering.split_even(I.table(spark, sf_dir, "orders").select("o_orderkey"), 7, ["o_orderkey"])


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority,
        (row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) - 1) // 42 AS file_no FROM orders"""
)
def chunk_files(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return numbering.chunk_files(rows, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], threshold=4200)


@query(
    """WITH size AS (SELECT avg(strlen('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}')) AS b
          FROM documents)
        SELECT doc_id, lang, source, CAST(floor((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1)
          / ceil(2000 / b)) AS BIGINT) AS file_no FROM documents, size"""
)
def chunk_measured(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return numbering.chunk_files(docs, ["lang"], ["doc_id"], threshold=2000, row_bytes="measured")


@query(
    """WITH RECURSIVE s AS (SELECT doc_id, lang, source, coalesce(octet_length(encode(text)), 0) AS b,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents),
        w AS (
          SELECT doc_id, lang, source, i, CAST(0 AS BIGINT) AS file_no, b AS held FROM s WHERE i = 1
          UNION ALL
          SELECT s.doc_id, s.lang, s.source, s.i, w.file_no + CAST(held >= 20000 AS BIGINT),
            CASE WHEN held >= 20000 THEN 0 ELSE held END + b
          FROM w JOIN s ON s.lang IS NOT DISTINCT FROM w.lang AND s.i = w.i + 1)
        SELECT doc_id, lang, source, file_no FROM w"""
)
def chunk_by_bytes(spark, sf_dir):
    """Files that close on the bytes of the rows written to them."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.octet_length("text").alias("size"))
    return chunks.chunk_by_bytes(docs, ["lang"], ["doc_id"], 20000, F.col("size")).drop("size")


@query(
    f"""SELECT 'loaded' AS stage, count(*) AS rows FROM ({I.LADDER_ROWS})
        UNION ALL SELECT 'players', count(DISTINCT puuid) FROM ({I.LADDER_ROWS})
        UNION ALL SELECT 'due', count(*) FROM ({I.PLAYER_STATE}) WHERE last_read IS NULL OR last_read < {I.SQL_AS_OF}
        UNION ALL SELECT 'failed', count(*) FROM ({I.REPLIES}) WHERE {I.SQL_OUTCOME} = 'error'"""
)
def run_summary(spark, sf_dir):
    ladder, state = I.ladder_rows(spark, sf_dir), I.player_state(spark, sf_dir)
    failed = classify(I.replies(spark, sf_dir)).where("outcome = 'error'")
    due = state.where(F.col("last_read").isNull() | (F.col("last_read") < F.lit(I.AS_OF).cast("date")))
    return summary.run_summary(
        {"loaded": ladder, "players": dedup.distinct_keys(ladder, "puuid"), "due": due, "failed": failed}
    )


@query(
    f"""WITH o AS (SELECT {I.SQL_OUTCOME} AS outcome, CASE WHEN status = 429 THEN TRY_CAST(retry_after AS DOUBLE) END AS wait
          FROM ({I.REPLIES}))
        SELECT 'RATE_LIMITED' AS result, count(*) FILTER (outcome IN ('ok', 'not_found')) AS done,
          count(*) FILTER (outcome NOT IN ('ok', 'not_found')) AS remaining, coalesce(max(wait), 120) + 2 AS delay_seconds
        FROM o"""
)
def resume_plan(spark, sf_dir):
    return summary.resume_plan(classify(I.replies(spark, sf_dir)))


@query(
    f"""SELECT puuid, tier, region, platform, tie FROM ({I.LADDER_ROWS}) WHERE tier = 'Gold'
        UNION ALL SELECT puuid, tier, region, platform, tie FROM ({I.LADDER_ROWS}) WHERE tier <> 'Gold'"""
)
def concat_strict(spark, sf_dir):
    rows = I.ladder_rows(spark, sf_dir)
    return parquet.concat_strict([rows.where("tier = 'Gold'"), rows.where("tier <> 'Gold'")], spark, rows.schema)


@query(
    f"""SELECT match_id, puuid, coalesce(is_ingested, 0) AS is_ingested, part, line
        FROM ({I.LISTINGS}) WHERE source_file_path LIKE '%O'
        UNION ALL SELECT match_id, puuid, 0, NULL, line FROM ({I.LISTINGS}) WHERE source_file_path LIKE '%F'"""
)
def concat_tolerant(spark, sf_dir):
    rows = I.listings(spark, sf_dir).select("match_id", "puuid", "is_ingested", "part", "line", "source_file_path")
    whole = rows.where("source_file_path LIKE '%O'").drop("source_file_path")
    lacking = rows.where("source_file_path LIKE '%F'").select("match_id", "puuid", "line")
    return parquet.concat_tolerant([whole, lacking], spark, whole.schema, {"is_ingested": 0})


@query(f"SELECT item, puuid FROM ({I.REPLIES}) WHERE {I.SQL_OUTCOME} = 'rate_limited'")
def resume_work(spark, sf_dir):
    replies = I.replies(spark, sf_dir)
    saved = classify(replies).where("outcome = 'rate_limited'")
    return joins.resume_work(replies.select("item", "puuid"), saved, ["item"])


@query(f"SELECT item, puuid FROM ({I.REPLIES})")
def resume_fallback(spark, sf_dir):
    replies = I.replies(spark, sf_dir)
    saved = classify(replies).where("outcome = 'no such outcome'")
    return joins.resume_work(replies.select("item", "puuid"), saved, ["item"])
