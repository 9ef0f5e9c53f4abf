"""Scalar functions, normalisation and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ranklake.functions import dates, hashing, layout, text
from ranklake.operators import filters, normalize
from ranklake.workload import Registry
from ranklake.workload import inputs as I

query = Registry()


@query(f"SELECT c_name, {I.sql_hash('c_name')} AS hash FROM customer")
def stable_hash(spark, sf_dir):
    return I.table(spark, sf_dir, "customer").select("c_name", hashing.stable_hash("c_name").alias("hash"))


@query(
    f"""SELECT doc_id, {I.sql_hash('text')} AS hash, {I.sql_shard('text')} AS shard_id,
        {I.sql_shard('text', 7)} AS shard_of_7, {I.sql_shard('text', 1)} AS shard_of_1 FROM documents"""
)
def assign_shard(spark, sf_dir):
    docs = I.table(spark, sf_dir, "documents").withColumn("hash", hashing.stable_hash("text"))
    return hashing.assign_shard(docs, "text").select(
        "doc_id",
        "hash",
        "shard_id",
        hashing.shard_of("text", 7).alias("shard_of_7"),
        hashing.shard_of("text", 1).alias("shard_of_1"),
    )


@query(
    f"""SELECT puuid, tie, CAST({I.SQL_RANK} AS INTEGER) AS tier_rank,
        coalesce(nullif(tier, ''), 'none') AS filled FROM ({I.LADDER_ROWS})"""
)
def tier_rank(spark, sf_dir):
    rows = I.ladder_rows(spark, sf_dir)
    return rows.select(
        "puuid", "tie", text.tier_rank("tier").alias("tier_rank"), text.blank_to("tier", "none").alias("filled")
    )


@query(
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS date, CAST(d AS DATE) AS utc_day
        FROM (SELECT o_orderkey, make_timestamp(epoch_ms(o_orderdate) * 1000) AS d FROM orders)"""
)
def partition_date(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").select("o_orderkey", dates.ntz_millis("o_orderdate").alias("ms"))
    return dates.with_partition_date(rows, "ms").select(
        "o_orderkey", "year", "month", "date", dates.utc_date("ms").alias("utc_day")
    )


@query(
    """SELECT event_id, CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS midnight,
        epoch_us(ts) // 1000 AS millis, strftime(ts, '%Y-%m-%d') AS iso FROM events"""
)
def date_epoch(spark, sf_dir):
    day = F.col("ts").cast("date")
    return I.table(spark, sf_dir, "events").select(
        "event_id",
        dates.midnight_epoch(day).alias("midnight"),
        dates.ntz_millis("ts").alias("millis"),
        day.cast("string").alias("iso"),
    )


@query(
    """SELECT event_id, CAST(ts AS DATE) AS from_text, CAST(ts AS DATE) AS from_timestamp,
        CAST(ts AS DATE) AS from_seconds, CAST(ts AS DATE) AS from_days,
        CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS from_number,
        CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) END AS from_missing FROM events"""
)
def parse_last_read(spark, sf_dir):
    day = F.col("ts").cast("date")
    seconds = F.floor(dates.ntz_millis("ts") / 1000)
    rows = I.table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        day.cast("string").alias("as_text"),
        F.timestamp_millis(dates.ntz_millis("ts")).alias("as_timestamp"),
        seconds.alias("as_seconds"),
        F.unix_date(day).alias("as_days"),
        F.when(F.col("event_type") == "error", float("nan")).otherwise(seconds.cast("double")).alias("as_number"),
        F.when(F.col("event_type") != "view", day.cast("string")).alias("missing"),
    )
    return rows.select(
        "event_id",
        dates.parse_date("as_text", "text").alias("from_text"),
        dates.parse_date("as_timestamp", "timestamp").alias("from_timestamp"),
        dates.parse_date("as_seconds", "epoch_seconds").alias("from_seconds"),
        dates.parse_date("as_days", "epoch_days").alias("from_days"),
        dates.parse_date("as_number", "epoch_seconds").alias("from_number"),
        dates.parse_date("missing", "text").alias("from_missing"),
    )


@query(
    f"""WITH m AS (SELECT o_orderkey, o_orderstatus AS region, o_orderpriority AS platform, o_custkey AS puuid,
          o_orderdate AS d, {I.sql_shard("CAST(o_orderkey AS VARCHAR)")} AS shard_id FROM orders)
        SELECT o_orderkey,
          'league/' || region || '/' || platform || '/gold/all/' AS league,
          'matchID/' || region || '/' || platform || '/' || puuid || '/' AS match_id,
          'match/' || region || '/' || platform || '/' || year(d) || '/' || month(d) || '/' || day(d) || '/' AS match,
          'workspace/puuid/' || shard_id || '/' AS player_shard,
          'workspace/matchid/' || shard_id || '/' AS match_shard,
          'workspace/tmp/b/' || puuid || '_' || shard_id || '.parquet' AS staging,
          'state/checkpoint/b/' || puuid || '_' || shard_id || '.json' AS resume,
          'iceberg/' || platform || '/' AS "table",
          'gs://lake/match/' || region || '/' || platform || '/' || year(d) || '/' || month(d) || '/' || day(d) || '/' AS uri,
          region || '_' || platform || '_' || year(d) || '_' || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '_'
            || lpad(CAST(day(d) AS VARCHAR), 2, '0') AS partition_key
        FROM m"""
)
def layout_paths(spark, sf_dir):
    order = I.table(spark, sf_dir, "orders")
    rows = order.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderpriority").alias("platform"),
        F.col("o_custkey").alias("puuid"),
        F.lit("GOLD").alias("tier"),
        F.lit(None).cast("string").alias("division"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("date"),
        hashing.shard_of("o_orderkey").alias("shard_id"),
        F.lit("b").alias("job_type"),
        F.col("o_custkey").alias("job_id"),
        hashing.shard_of("o_orderkey").alias("part"),
        F.col("o_orderpriority").alias("table_name"),
    )
    return rows.select(
        "o_orderkey",
        *[layout.layout_path(kind).alias(kind) for kind in layout.LAYOUT],
        layout.table_uri("gs://lake", F.concat(F.lit("/"), layout.layout_path("match"))).alias("uri"),
        layout.partition_text("region", "platform", "year", "month", "date").alias("partition_key"),
    )


@query(
    """SELECT o_orderkey, o_orderstatus AS region, o_orderpriority AS platform, CAST(year(o_orderdate) AS VARCHAR) AS year,
        CAST(month(o_orderdate) AS VARCHAR) AS month, CAST(day(o_orderdate) AS VARCHAR) AS date, 'part-0.parquet' AS file
        FROM orders"""
)
def path_columns(spark, sf_dir):
    order = I.table(spark, sf_dir, "orders")
    rows = order.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderpriority").alias("platform"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("date"),
    )
    names = ["region", "platform", "year", "month", "date"]
    paths = rows.select(
        "o_orderkey", F.concat(layout.layout_path("match"), F.lit("part-0.parquet")).alias("source_file_path")
    )
    return layout.with_path_columns(paths, names).select(
        "o_orderkey", *names, layout.file_name("source_file_path").alias("file")
    )


@query(
    f"""SELECT {I.SQL_ENTRY_COLUMNS}, upper(c_mktsegment) AS tier, 'all' AS division, r_name AS region,
        n_name AS platform, {I.SQL_STAMP} AS _ingested_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def normalize_entries(spark, sf_dir):
    placed = I.table(spark, sf_dir, "customer").join(
        I.nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = placed.select(
        I.customer_entry().alias("entry"),
        F.lower("c_mktsegment").alias("tier"),
        F.lit(None).cast("string").alias("division"),
        "region",
        F.col("id").alias("platform"),
    )
    return normalize.normalize_entries(rows, I.STAMP)


_REQUIRED_MET = "c_mktsegment <> 'BUILDING' AND c_acctbal > 100"


def _entries(spark, sf_dir):
    losses = F.col("c_nationkey").cast("int")
    entry = I.customer_entry().withField("losses", losses)
    return I.table(spark, sf_dir, "customer").select("c_custkey", entry.alias("entry"))


@query(
    f"""SELECT 'id-' || c_name AS summoner_id, c_name AS summoner_name, c_name AS puuid, 'I' AS rank,
        CAST(floor(c_acctbal) AS INTEGER) AS league_points, c_nationkey AS wins, c_nationkey AS losses,
        c_mktsegment AS tier, 'RANKED_SOLO_5x5' AS queue_type, c_acctbal > 5000 AS veteran,
        c_mktsegment = 'MACHINERY' AS inactive, false AS fresh_blood, c_acctbal > 7000 AS hot_streak
        FROM customer WHERE {_REQUIRED_MET}"""
)
def strict_entries(spark, sf_dir):
    return normalize.strict_entries(_entries(spark, sf_dir))[0]


@query(
    f"""SELECT c_custkey, concat_ws(',', CASE WHEN c_mktsegment = 'BUILDING' THEN 'summonerId' END,
          CASE WHEN NOT c_acctbal > 100 THEN 'rank' END,
          CASE WHEN NOT c_acctbal > 0 THEN 'leaguePoints' END) AS missing
        FROM customer WHERE NOT ({_REQUIRED_MET})"""
)
def strict_rejects(spark, sf_dir):
    rejects = normalize.strict_entries(_entries(spark, sf_dir))[1]
    return rejects.select("c_custkey", F.concat_ws(",", "missing").alias("missing"))


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS match_id, {I.sql_match_columns()},
        o_orderstatus AS region, o_orderpriority AS platform FROM orders"""
)
def normalize_match(spark, sf_dir):
    rows = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderpriority").alias("platform"),
        I.match_body().alias("body"),
    )
    return normalize.normalize_match(rows, I.STAMP)


@query(
    f"""SELECT match_id, puuid, CAST(0 AS INTEGER) AS is_ingested, 'asia' AS region, queue AS platform,
        {I.SQL_STAMP} AS _ingested_at FROM ({I.ID_LIST})"""
)
def id_records(spark, sf_dir):
    rows = I.id_list(spark, sf_dir).withColumns({"region": F.lit("asia"), "platform": F.col("queue")})
    return normalize.id_records(rows, I.STAMP)


@query(f"SELECT puuid, tie, tier FROM ({I.LADDER_ROWS}) WHERE tier IS NOT NULL AND tier <> ''")
def valid_key(spark, sf_dir):
    return filters.valid_key(I.ladder_rows(spark, sf_dir), "tier").select("puuid", "tie", "tier")


@query(f"SELECT * FROM ({I.PLAYER_STATE}) WHERE last_read IS NULL OR last_read < {I.SQL_AS_OF}")
def due_filter(spark, sf_dir):
    return filters.due(I.player_state(spark, sf_dir), I.AS_OF)


@query(f"SELECT match_id, puuid, part, line FROM ({I.LISTINGS}) WHERE is_ingested = 0")
def pending_filter(spark, sf_dir):
    return filters.pending(I.listings(spark, sf_dir)).select("match_id", "puuid", "part", "line")


@query(
    f"""SELECT puuid, pos, match_id, last_read FROM ({I.ID_LIST}) JOIN ({I.PLAYER_STATE}) USING (puuid)
        WHERE queue = 'view' AND (last_read IS NULL
          OR game_start_timestamp >= epoch_ms(CAST(last_read AS TIMESTAMP)))"""
)
def since_filter(spark, sf_dir):
    rows = I.id_list(spark, sf_dir).join(I.player_state(spark, sf_dir), "puuid")
    return filters.since(rows, "last_read", queue="view").select("puuid", "pos", "match_id", "last_read")


@query(
    f"""SELECT platform, tier, division, page FROM ({I.PAGES})
        WHERE tier = 'BUILDING' AND division = 'I' AND page <= 1"""
)
def scope_filter(spark, sf_dir):
    pages = I.customers_placed(spark, sf_dir).select("platform", "tier", "division", "page").distinct()
    return filters.scope(pages, page=1, tier="BUILDING", division="I", platform=None)


@query(
    f"""SELECT item, {I.SQL_OUTCOME} AS outcome,
        CASE WHEN status = 429 THEN TRY_CAST(retry_after AS DOUBLE) END AS retry_after_seconds
        FROM ({I.REPLIES})"""
)
def classify_outcome(spark, sf_dir):
    return normalize.classify(I.replies(spark, sf_dir)).select("item", "outcome", "retry_after_seconds")
