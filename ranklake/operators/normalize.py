"""From landed JSON to the columns of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklake.functions.dates import as_timestamp
from ranklake.functions.text import or_default

_ENTRY_DEFAULTS = [
    # column, field, default
    ("puuid", "puuid", ""),
    ("summoner_id", "summonerId", ""),
    ("summoner_name", "summonerName", ""),
    ("league_points", "leaguePoints", 0),
    ("wins", "wins", 0),
    ("losses", "losses", 0),
    ("veteran", "veteran", False),
    ("inactive", "inactive", False),
    ("fresh_blood", "freshBlood", False),
    ("hot_streak", "hotStreak", False),
]
_REQUIRED = [
    "summonerId", "summonerName", "puuid", "rank", "leaguePoints", "wins", "losses", "tier", "queueType",
]
_BODY = (
    "metadata struct<participants: string>, "
    "info struct<gameStartTimestamp: string, gameDuration: string, gameVersion: string, queueId: string, "
    "participants: string, teams: string>"
)


def normalize_entries(df: DataFrame, ingested_at, entry: str = "entry") -> DataFrame:
    """Ladder rows from one ``entry`` struct per row plus tier, division, region and platform."""
    filled = {name: or_default(F.col(f"{entry}.{field}"), default) for name, field, default in _ENTRY_DEFAULTS}
    filled["tier"] = F.upper("tier")
    filled["division"] = F.coalesce(F.nullif("division", F.lit("")), F.lit("all"))
    filled["region"], filled["platform"] = F.col("region"), F.col("platform")
    filled["_ingested_at"] = as_timestamp(ingested_at)
    order = [
        "puuid", "summoner_id", "summoner_name", "tier", "division", "league_points", "wins", "losses",
        "veteran", "inactive", "fresh_blood", "hot_streak", "region", "platform", "_ingested_at",
    ]
    return df.select(*[filled[name].alias(name) for name in order])


def strict_entries(df: DataFrame, entry: str = "entry") -> tuple[DataFrame, DataFrame]:
    """Split into entries with all required fields, flags defaulted, and rejects with what they lack."""
    missing = F.array_compact(F.array(*[F.when(F.col(f"{entry}.{f}").isNull(), F.lit(f)) for f in _REQUIRED]))
    checked = df.withColumn("missing", missing)
    names = {"freshBlood": "fresh_blood", "hotStreak": "hot_streak"}
    flags = [
        or_default(F.col(f"{entry}.{f}"), False).alias(names.get(f, f))
        for f in ("veteran", "inactive", "freshBlood", "hotStreak")
    ]
    renamed = {
        "summonerId": "summoner_id", "summonerName": "summoner_name",
        "leaguePoints": "league_points", "queueType": "queue_type",
    }
    fields = [F.col(f"{entry}.{f}").alias(renamed.get(f, f)) for f in _REQUIRED]
    valid = checked.where(F.size("missing") == 0).select(*fields, *flags)
    return valid, checked.where(F.size("missing") > 0)


def parse_match(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``_doc``, the parsed body, whose ``_broken`` is set where the body is no JSON.

    There is no limit on its size; Spark copies what is nested at most 1000 deep.
    """
    whole = {f"max{what}": str(2**31 - 1) for what in ("NestingDepth", "StringLen", "NumLen")}
    options = {**whole, "columnNameOfCorruptRecord": "_broken"}
    return df.withColumn("_doc", F.from_json(body, f"{_BODY}, _broken string", options))


def normalize_match(
    df: DataFrame, ingested_at, body: str = "body", participants_from: str = "metadata"
) -> DataFrame:
    """Match rows from one JSON body per row. Parses each body once; arrays stay JSON text.

    Rows that ``parse_match`` has seen keep what it found.
    """
    if participants_from not in ("metadata", "info"):
        raise ValueError(f"participants_from must be 'metadata' or 'info', got {participants_from!r}")
    parsed = df if "_doc" in df.columns else parse_match(df, body)
    return parsed.select(
        "match_id",
        or_default(F.col("_doc.info.gameStartTimestamp").try_cast("long"), 0).cast("long").alias("game_start_timestamp"),
        or_default(F.col("_doc.info.gameDuration").try_cast("long"), 0).cast("long").alias("game_duration"),
        or_default("_doc.info.gameVersion", "").alias("game_version"),
        or_default(F.col("_doc.info.queueId").try_cast("int"), 0).cast("int").alias("queue_id"),
        or_default(f"_doc.{participants_from}.participants", "[]").alias("participants"),
        or_default("_doc.info.teams", "[]").alias("teams"),
        "region",
        "platform",
        as_timestamp(ingested_at).alias("_ingested_at"),
    )


def id_records(df: DataFrame, ingested_at) -> DataFrame:
    """New match-id rows, not yet ingested."""
    return df.select(
        "match_id",
        "puuid",
        F.lit(0).alias("is_ingested"),
        "region",
        "platform",
        as_timestamp(ingested_at).alias("_ingested_at"),
    )


def outcome(status: str | Column) -> Column:
    """What a reply status means for the work item. NULL stands for a transport failure."""
    s = F.col(status) if isinstance(status, str) else status
    return (
        F.when(s.isNull() | s.isin(500, 502, 503, 504), "transient")
        .when(s == 429, "rate_limited")
        .when(s == 404, "not_found")
        .when(s >= 400, "error")
        .otherwise("ok")
    )


def classify(df: DataFrame, status: str = "status", header: str = "retry_after") -> DataFrame:
    """Add ``outcome`` and, for rate-limited rows, the wait in seconds as ``retry_after_seconds``."""
    wait = F.when(F.col(status) == 429, F.col(header).cast("string").try_cast("double"))
    return df.withColumns({"outcome": outcome(status), "retry_after_seconds": wait})


DONE = ("ok", "not_found")


def is_done(col: str = "outcome") -> Column:
    """Only these outcomes advance the state of an item."""
    return F.col(col).isin(*DONE)
