"""The benchmark tables read as ladder rows, player state, id lists, listings and replies.

Each input exists twice: as a DataFrame function and, under the same name in upper case,
as the text of the SQL query that DuckDB runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.functions.dates import ntz_millis

STAMP = "2024-02-01T00:00:00"
SQL_STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "2024-01-25"
SQL_AS_OF = "DATE '2024-01-25'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Ladder rows: one per order, so a player (customer) occurs in several tiers.
LADDER_ROWS = """
SELECT CAST(o_custkey AS VARCHAR) AS puuid,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'challenger' WHEN '2-HIGH' THEN 'Gold' WHEN '3-MEDIUM' THEN ''
            WHEN '4-NOT SPECIFIED' THEN 'unranked' ELSE 'IRON' END AS tier,
       o_orderstatus AS region, o_orderpriority AS platform, o_orderkey AS tie
FROM orders
"""


def ladder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("puuid"),
        F.when(priority == "1-URGENT", "challenger")
        .when(priority == "2-HIGH", "Gold")
        .when(priority == "3-MEDIUM", "")
        .when(priority == "4-NOT SPECIFIED", "unranked")
        .otherwise("IRON")
        .alias("tier"),
        F.col("o_orderstatus").alias("region"),
        priority.alias("platform"),
        F.col("o_orderkey").alias("tie"),
    )


SQL_RANK = """CASE lower(coalesce(nullif(tier, ''), 'bronze'))
 WHEN 'challenger' THEN 0 WHEN 'grandmaster' THEN 1 WHEN 'master' THEN 2 WHEN 'diamond' THEN 3
 WHEN 'emerald' THEN 4 WHEN 'platinum' THEN 5 WHEN 'gold' THEN 6 WHEN 'silver' THEN 7
 WHEN 'bronze' THEN 8 WHEN 'iron' THEN 9 ELSE 999 END"""


def sql_hash(column: str) -> str:
    return f"CAST(('0x' || substr(md5({column}), 1, 16))::UBIGINT AS DECIMAL(20, 0))"


def sql_shard(column: str, shards: int = 4) -> str:
    return f"CAST(('0x' || substr(md5({column}), 1, 16))::UBIGINT % {shards} AS INTEGER)"


# Player state: the last day with a signup above 50, NULL for users without one.
PLAYER_STATE = """
SELECT CAST(user_id AS VARCHAR) AS puuid,
       CAST(max(CASE WHEN event_type = 'signup' AND value > 50 THEN ts END) AS DATE) AS last_read
FROM events GROUP BY user_id
"""


def player_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = F.when((F.col("event_type") == "signup") & (F.col("value") > 50), F.col("ts"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("puuid"))
        .agg(F.max(read).cast("date").alias("last_read"))
    )


# Players on the ladder now: customers whose balance is not negative.
CURRENT_PLAYERS = "SELECT CAST(c_custkey AS VARCHAR) AS puuid FROM customer WHERE c_acctbal >= 0"


def current_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return rows.select(F.col("c_custkey").cast("string").alias("puuid"))


# Ordered id lists: one per user, in event order; the id is the JSON value k, which repeats.
ID_LIST = """
SELECT CAST(user_id AS VARCHAR) AS puuid, event_id AS pos, json_extract_string(props, '$.k') AS match_id,
       event_type AS queue, epoch_us(ts) // 1000 AS game_start_timestamp
FROM events
"""


def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("puuid"),
        F.col("event_id").alias("pos"),
        F.get_json_object("props", "$.k").alias("match_id"),
        F.col("event_type").alias("queue"),
        ntz_millis("ts").alias("game_start_timestamp"),
    )


# Ids stored by earlier runs: those of large purchases.
KNOWN_IDS = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS puuid, json_extract_string(props, '$.k') AS match_id
FROM events WHERE event_type = 'purchase' AND value > 60
"""


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where((F.col("event_type") == "purchase") & (F.col("value") > 60))
        .select(F.col("user_id").cast("string").alias("puuid"), F.get_json_object("props", "$.k").alias("match_id"))
        .distinct()
    )


# Listings: a match (order) is listed by several players (suppliers), in one source per flag pair.
LISTINGS = """
SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_suppkey AS VARCHAR) AS puuid,
       CAST(CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_returnflag = 'R' THEN NULL ELSE 0 END AS INTEGER) AS is_ingested,
       l_returnflag || l_linestatus AS source_file_path,
       l_partkey AS part, l_linenumber AS line
FROM lineitem
"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_linestatus") == "F", 1).when(F.col("l_returnflag") == "R", None).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("match_id"),
        F.col("l_suppkey").cast("string").alias("puuid"),
        flag.cast("int").alias("is_ingested"),
        F.concat("l_returnflag", "l_linestatus").alias("source_file_path"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
    )


SPREAD = ["puuid", "part", "line"]  # what differs between listings of one match


# Matches that are done: finished orders.
DONE_MATCHES = "SELECT CAST(o_orderkey AS VARCHAR) AS match_id FROM orders WHERE o_orderstatus = 'F'"


def done_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return rows.select(F.col("o_orderkey").cast("string").alias("match_id"))


# Replies to work items: the event type stands for a status, the value for the Retry-After header.
REPLIES = """
SELECT event_id AS item, CAST(user_id AS VARCHAR) AS puuid,
       CAST(CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 WHEN 'purchase' THEN 429
            WHEN 'click' THEN 200 ELSE CASE WHEN value > 100 THEN 403 WHEN value > 50 THEN NULL ELSE 200 END
            END AS INTEGER) AS status,
       CASE WHEN value > 80 THEN 'soon' ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS retry_after
FROM events
"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when(kind == "error", 500)
        .when(kind == "signup", 404)
        .when(kind == "purchase", 429)
        .when(kind == "click", 200)
        .when(value > 100, 403)
        .when(value > 50, None)
        .otherwise(200)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("item"),
        F.col("user_id").cast("string").alias("puuid"),
        status.cast("int").alias("status"),
        F.when(value > 80, "soon").otherwise(F.floor(value).cast("int").cast("string")).alias("retry_after"),
    )


SQL_OUTCOME = """CASE WHEN status IS NULL OR status IN (500, 502, 503, 504) THEN 'transient'
 WHEN status = 429 THEN 'rate_limited' WHEN status = 404 THEN 'not_found'
 WHEN status >= 400 THEN 'error' ELSE 'ok' END"""


# Landed ladder pages: customers by nation, segment and key range; a page whose customers all
# have a negative balance is empty, and one with a balance below -900 failed.
PAGES = """
SELECT n_name AS platform, c_mktsegment AS tier, CASE WHEN c_acctbal > 4000 THEN 'I' ELSE 'II' END AS division,
       CAST(c_custkey // 100 AS INTEGER) AS page, min(c_acctbal) AS lowest, max(c_acctbal) AS highest
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
"""
PAGE_ENTRIES = """
SELECT n_name AS platform, c_mktsegment AS tier, CASE WHEN c_acctbal > 4000 THEN 'I' ELSE 'II' END AS division,
       CAST(c_custkey // 100 AS INTEGER) AS page, c_name, c_acctbal, c_nationkey, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
_FIELDS = (
    "puuid", "summonerId", "summonerName", "rank", "tier", "queueType", "leaguePoints", "wins", "losses",
    "veteran", "inactive", "freshBlood", "hotStreak",
)


def customer_entry() -> Column:
    """A customer as a ladder entry. Some fields are absent for some customers."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    values = {
        "puuid": F.col("c_name"),
        "summonerId": F.when(segment != "BUILDING", F.concat(F.lit("id-"), "c_name")),
        "summonerName": F.col("c_name"),
        "rank": F.when(balance > 100, "I"),
        "tier": segment,
        "queueType": F.lit("RANKED_SOLO_5x5"),
        "leaguePoints": F.when(balance > 0, F.floor(balance).cast("int")),
        "wins": F.col("c_nationkey").cast("int"),
        "losses": F.lit(None).cast("int"),
        "veteran": balance > 5000,
        "inactive": F.when(segment == "MACHINERY", True),
        "freshBlood": F.lit(None).cast("boolean"),
        "hotStreak": F.when(segment != "BUILDING", balance > 7000),
    }
    return F.struct(*[values[f].alias(f) for f in _FIELDS])


SQL_ENTRY_COLUMNS = """
 c_name AS puuid, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'id-' || c_name ELSE '' END AS summoner_id,
 c_name AS summoner_name,
 CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS INTEGER) ELSE 0 END AS league_points,
 c_nationkey AS wins, 0 AS losses, c_acctbal > 5000 AS veteran, c_mktsegment = 'MACHINERY' AS inactive,
 false AS fresh_blood, c_mktsegment <> 'BUILDING' AND c_acctbal > 7000 AS hot_streak"""


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation as platform, with its region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey"), F.col("n_name").alias("id"), F.col("r_name").alias("region")
    )


def customers_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation as platform and a division by balance."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns(
            {
                "platform": F.col("n_name"),
                "tier": F.col("c_mktsegment"),
                "division": F.when(F.col("c_acctbal") > 4000, "I").otherwise("II"),
                "page": F.floor(F.col("c_custkey") / 100).cast("int"),
            }
        )
    )


def ladder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages. A page spans 100 customer keys, so its list of entries is bounded."""
    entry = F.when(F.col("c_acctbal") >= 0, customer_entry())
    return (
        customers_placed(spark, sf_dir)
        .groupBy("platform", "tier", "division", "page")
        .agg(
            F.when(F.min("c_acctbal") < -900, 503).otherwise(200).alias("status"),
            F.lit(None).cast("string").alias("retry_after"),
            F.collect_list(entry).alias("entries"),
        )
    )


def apex_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-page tiers: suppliers by nation and range of 100 keys."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    values = {
        "puuid": F.col("s_name"),
        "leaguePoints": F.when(F.col("s_acctbal") > 0, F.floor("s_acctbal").cast("int")),
        "wins": F.col("s_nationkey").cast("int"),
        "losses": F.lit(None).cast("int"),
        "veteran": F.col("s_acctbal") > 5000,
    }
    kinds = {"inactive": "boolean", "freshBlood": "boolean", "hotStreak": "boolean"}
    entry = F.struct(
        *[values.get(f, F.lit(None).cast(kinds.get(f, "string"))).alias(f) for f in _FIELDS]
    )
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("platform"), F.floor(F.col("s_suppkey") / 100).alias("_range"))
        .agg(F.collect_list(entry).alias("entries"))
        .select(
            "platform",
            F.lit("challenger").alias("tier"),
            F.lit(None).cast("string").alias("division"),
            F.lit(200).alias("status"),
            F.lit(None).cast("string").alias("retry_after"),
            "entries",
        )
    )


# Match replies: one JSON body per order.
def match_body(day: str | Column = "o_orderdate") -> Column:
    low = F.col("o_orderpriority") == "5-LOW"
    start = F.when(~low, ntz_millis(day))
    info = F.struct(
        start.alias("gameStartTimestamp"),
        F.floor("o_totalprice").cast("long").alias("gameDuration"),
        F.col("o_orderpriority").alias("gameVersion"),
        F.lit(420).alias("queueId"),
        F.array(F.struct(F.col("o_custkey").alias("teamId"))).alias("teams"),
    )
    people = F.struct(F.array(F.col("o_custkey").cast("string")).alias("participants"))
    has_people = F.col("o_orderstatus") != "P"
    return F.to_json(F.struct(F.when(has_people, people).alias("metadata"), info.alias("info")))


def sql_match_columns(day: str = "o_orderdate") -> str:
    return f"""
 CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE epoch_us({day}) // 1000 END AS game_start_timestamp,
 CAST(floor(o_totalprice) AS BIGINT) AS game_duration, o_orderpriority AS game_version,
 CAST(420 AS INTEGER) AS queue_id,
 CASE WHEN o_orderstatus <> 'P' THEN '["' || o_custkey || '"]' ELSE '[]' END AS participants,
 '[{{"teamId":' || o_custkey || '}}]' AS teams, {SQL_STAMP} AS _ingested_at"""


def match_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies to match requests; orders that are still open were not found.

    Matches start on the first of the month of their order, so that a day has many of them.
    """
    first = F.trunc(F.col("o_orderdate").cast("date"), "month").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.when(F.col("o_orderstatus") == "O", 404).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("retry_after"),
        match_body(first).alias("body"),
    )
