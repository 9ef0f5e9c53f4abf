"""Column types of every table, and the fixed values of the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

# --- Fixed values: the dimensions, ranks and limits the results depend on. ---
PLATFORMS = [
    # id, region, display_name, api_platform, shard_id
    ("kr", "asia", "Korea", "kr", 0),
    ("vn2", "sea", "Vietnam", "vn2", 1),
    ("euw1", "europe", "Europe West", "euw1", 2),
    ("eun1", "europe", "Europe Nordic & East", "eun1", 3),
]
REGIONS = [("asia", "asia"), ("sea", "sea"), ("europe", "europe")]  # region, match_api_cluster
APEX_TIERS = ["challenger", "grandmaster", "master"]
TIERS = ["iron", "bronze", "silver", "gold", "platinum", "emerald", "diamond"]
DIVISIONS = ["I", "II", "III", "IV"]
TIER_RANKS = {
    "challenger": 0,
    "grandmaster": 1,
    "master": 2,
    "diamond": 3,
    "emerald": 4,
    "platinum": 5,
    "gold": 6,
    "silver": 7,
    "bronze": 8,
    "iron": 9,
}
BLANK_TIER = "bronze"
UNKNOWN_TIER_RANK = 999
SHARDS = 4
QUEUE = 420
PAGE_SIZE = 100
IDS_PER_PLAYER = 1000
ATTEMPTS = 5
RETRY_DEFAULT_SECONDS = 120
RETRY_MARGIN_SECONDS = 2
ROWS_PER_GROUP = 1000
ROW_BYTES = 100
MEGABYTE = 1024 * 1024
FLUSH_BYTES = {"ladder": 4 * MEGABYTE, "match_ids": 1 * MEGABYTE, "matches": 32 * MEGABYTE}
REGISTERED_TABLES = {"league": "league", "match_id": "matchID", "match": "match"}  # name, folder
# --- end of fixed values ---


_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _struct(columns: str) -> StructType:
    """Columns written as ``name type``. Needs no session, unlike a DDL text."""
    out = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        out = out.add(name, _TYPES[kind])
    return out


ENTRY = _struct(
    "puuid string, summonerId string, summonerName string, rank string, tier string, queueType string, "
    "leaguePoints int, wins int, losses int, "
    "veteran boolean, inactive boolean, freshBlood boolean, hotStreak boolean"
)
LADDER_PAGES = _struct(
    "platform string, tier string, division string, page int, status int, retry_after string"
).add("entries", ArrayType(ENTRY))
LADDER = _struct(
    "puuid string, summoner_id string, summoner_name string, tier string, division string, "
    "league_points int, wins int, losses int, "
    "veteran boolean, inactive boolean, fresh_blood boolean, hot_streak boolean, "
    "region string, platform string, _ingested_at timestamp"
)
#: Stored rows have the day of ingestion as a folder, so that a day never touches the files of another.
DAY = "ingested_on"
LADDER_STORED = StructType([*LADDER.fields]).add(DAY, DateType())
PLAYER_STATE = _struct("puuid string, last_read date, region string, platform string, shard_id int")
ID_PAGES = _struct("puuid string, queue int, start long").add("ids", ArrayType(StringType()))
MATCH_IDS = _struct(
    "match_id string, puuid string, is_ingested int, region string, platform string, _ingested_at timestamp"
)
MATCH_STATE = _struct(
    "match_id string, is_ingested int, region string, platform string, puuid string, "
    "source_file_path string, shard_id int"
)
MATCH_REPLIES = _struct("match_id string, status int, retry_after string, body string")
MATCHES = _struct(
    "match_id string, game_start_timestamp long, game_duration long, game_version string, queue_id int, "
    "participants string, teams string, region string, platform string, _ingested_at timestamp"
)
# One row per item that is left, so that a part of any size stays spread over tasks.
RESUME = _struct(
    "job_type string, job_id string, part int, shard_id int, item string, staging_path string, "
    "retry_after_seconds double, checkpoint_timestamp timestamp"
)
FILE_LEDGER = _struct(
    "table_name string, file_path string, record_count long, bytes long, snapshot_id long, registered_at timestamp"
)


def platforms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PLATFORMS, "id string, region string, display_name string, api_platform string, shard_id int"
    )


def regions(spark: SparkSession, gateway: str | None = None) -> DataFrame:
    """Regions and their cluster. ``gateway`` is a URL pattern with ``{}`` for the cluster."""
    rows = [(region, cluster, gateway.format(cluster) if gateway else None) for region, cluster in REGIONS]
    return spark.createDataFrame(rows, "region string, match_api_cluster string, api_gateway string")


def tiers(spark: SparkSession) -> DataFrame:
    rows = [(tier, rank, tier in APEX_TIERS) for tier, rank in TIER_RANKS.items()]
    return spark.createDataFrame(rows, "tier string, rank int, apex boolean")
