"""Scans, sinks, the file registry and the file streams.

Each query writes the rows it needs to a folder of its own under the shared folder, and
returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ranklake.functions import hashing
from ranklake.operators import numbering, summary
from ranklake.operators.normalize import classify, normalize_entries
from ranklake.plans import registry
from ranklake.schemas import FLUSH_BYTES, LADDER_PAGES, ROWS_PER_GROUP, SHARDS
from ranklake.session import scratch_path
from ranklake.sinks import resume, staging, tables, versions
from ranklake.sources import files, pages, parquet
from ranklake.streaming import files as streams
from ranklake.workload import Registry
from ranklake.workload import inputs as I

query = Registry()


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS rows, max(o_orderkey) AS newest FROM orders GROUP BY ALL")
def scan_prefix(spark, sf_dir):
    schema = I.table(spark, sf_dir, "orders").schema
    rows = parquet.scan(spark, f"{sf_dir}/orders.parquet", schema)
    return rows.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("rows"), F.max("o_orderkey").alias("newest")
    )


@query("SELECT count(*) AS rows, count(*) AS places FROM lineitem")
def scan_with_source(spark, sf_dir):
    """Every row has a file and a place in it that no other row has."""
    schema = StructType([StructField("l_orderkey", I.table(spark, sf_dir, "lineitem").schema["l_orderkey"].dataType)])
    rows = parquet.scan_with_source(spark, f"{sf_dir}/lineitem.parquet", schema)
    return (
        rows.select("source_file_path", "source_row")
        .distinct()
        .agg(F.count("*").alias("places"))
        .select("places", rows.agg(F.count("*")).scalar().alias("rows"))
    )


@query(
    f"""SELECT match_id, puuid, coalesce(is_ingested, 0) AS is_ingested FROM ({I.LISTINGS}) WHERE source_file_path LIKE '%O'
        UNION ALL SELECT match_id, puuid, 0 FROM ({I.LISTINGS}) WHERE source_file_path LIKE '%F'"""
)
def scan_defaults(spark, sf_dir):
    """Some files lack ``is_ingested``."""
    path = scratch_path(spark, "defaults")
    rows = I.listings(spark, sf_dir)
    whole = rows.select("match_id", "puuid", "is_ingested")
    tables.append(whole.where(F.col("source_file_path").like("%O")), path)
    tables.append(rows.where(F.col("source_file_path").like("%F")).select("match_id", "puuid"), path)
    return parquet.scan_tolerant(spark, path, whole.schema, {"is_ingested": 0})


@query(
    f"""WITH e AS (SELECT platform, tier, division, min(page) AS last FROM ({I.PAGES})
          WHERE highest < 0 OR lowest < -900 GROUP BY ALL)
        SELECT p.platform, p.tier, p.division, p.page, c_name FROM ({I.PAGE_ENTRIES}) p
        LEFT JOIN e ON e.platform = p.platform AND e.tier = p.tier AND e.division = p.division
        WHERE c_acctbal >= 0 AND (last IS NULL OR page < last)"""
)
def ladder_pages(spark, sf_dir):
    landed = I.ladder_pages(spark, sf_dir)
    rows = pages.pages_until_empty(landed, ["platform", "tier", "division"], status="status")
    return rows.select("platform", "tier", "division", "page", F.col("entry.puuid").alias("c_name"))


@query(
    f"""WITH e AS (SELECT platform, tier, division, min(page) AS last FROM ({I.PAGES})
          WHERE highest < 0 OR lowest < -900 GROUP BY ALL)
        SELECT {I.SQL_ENTRY_COLUMNS}, p.platform, upper(p.tier) AS tier, p.division FROM ({I.PAGE_ENTRIES}) p
        LEFT JOIN e ON e.platform = p.platform AND e.tier = p.tier AND e.division = p.division
        WHERE c_acctbal >= 0 AND (last IS NULL OR page < last)"""
)
def landed_pages(spark, sf_dir):
    """Pages landed as JSON lines, in which absent fields are left out, read back and normalised."""
    path = scratch_path(spark, "landed")
    I.ladder_pages(spark, sf_dir).write.json(path)
    landed = pages.read_landed(spark, path, LADDER_PAGES)
    rows = pages.pages_until_empty(landed, ["platform", "tier", "division"], status="status")
    return normalize_entries(rows.withColumn("region", F.lit("")), I.STAMP).drop("region", "_ingested_at")


@query(
    """WITH e AS (SELECT conv_id, min(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY 1)
        SELECT c.conv_id, turn, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations) c
        LEFT JOIN e ON c.conv_id = e.conv_id WHERE last IS NULL OR turn < last"""
)
def pages_until_empty(spark, sf_dir):
    """Turns as pages of words; a turn of the assistant counts as an empty page."""
    turns = I.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") != "assistant", F.split("text", " ", -1)).alias("entries")
    )
    return pages.pages_until_empty(turns, ["conv_id"], page="turn", name="word")


@query("SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE lang <> 'de'")
def explode_entries(spark, sf_dir):
    """Documents as single pages of lines; a German one counts as a page without entries."""
    docs = I.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "de", F.split("text", "\n", -1)).alias("entries")
    )
    return pages.explode_entries(docs, name="line")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_roundtrip(spark, sf_dir):
    """Two appends to one table."""
    path = scratch_path(spark, "append")
    rows = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables.append(rows.where("o_orderstatus = 'F'"), path)
    tables.append(rows.where("o_orderstatus <> 'F'"), path)
    return parquet.scan(spark, path, rows.schema)


@query(
    f"""SELECT puuid, CASE WHEN shard_id = 2 THEN {I.SQL_AS_OF} ELSE last_read END AS last_read, shard_id
        FROM (SELECT *, {I.sql_shard("puuid")} AS shard_id FROM ({I.PLAYER_STATE}))"""
)
def overwrite_one_shard(spark, sf_dir):
    path = scratch_path(spark, "shards")
    rows = hashing.assign_shard(I.player_state(spark, sf_dir), "puuid")
    tables.write_partitioned(rows, path, ["shard_id"])
    changed = rows.where("shard_id = 2").withColumn("last_read", F.lit(I.AS_OF).cast("date"))
    tables.overwrite_partitions(changed, path, ["shard_id"])
    return parquet.scan_table(spark, path, rows.schema)


@query(
    """SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows,
        true AS within_limit FROM lineitem GROUP BY ALL"""
)
def write_partitioned(spark, sf_dir):
    """No file mixes partitions, and none holds more rows than fit the ladder threshold."""
    path = scratch_path(spark, "partitioned")
    rows = I.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")
    )
    by = ["l_returnflag", "l_linestatus", "year"]
    limit = numbering.rows_per_file(FLUSH_BYTES["ladder"])
    tables.write_partitioned(rows, path, by, limit)
    stored = parquet.scan_table(spark, path, rows.schema)
    per_file = stored.groupBy(*by, F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return per_file.groupBy(*by).agg(F.sum("n").alias("rows"), (F.max("n") <= limit).alias("within_limit"))


@query(
    """SELECT l_returnflag, count(*) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY ALL"""
)
def row_groups(spark, sf_dir):
    """Rows written in row groups of 1000 read back whole."""
    path = scratch_path(spark, "row-groups")
    rows = I.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    tables.write_partitioned(rows, path, ["l_returnflag"], rows_per_group=ROWS_PER_GROUP)
    stored = parquet.scan_table(spark, path, rows.schema)
    return stored.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


@query(f"SELECT match_id, puuid, pos FROM ({I.ID_LIST})")
def stage_restore(spark, sf_dir):
    """Output staged by a run that was cut short, joined by the output of the run that resumed it."""
    root = scratch_path(spark, "staging")
    rows = I.id_list(spark, sf_dir)
    columns = ["match_id", "puuid", "pos"]
    staging.stage(rows.where("queue = 'view'").select(*columns), root, "b", "job-1")
    staging.stage(rows.where("queue = 'view'").select(*columns), root, "b", "dropped")
    staging.drop_stage(spark, root, "b", "dropped")
    rest = rows.where("queue <> 'view'").select(*columns)
    return staging.with_staged(staging.with_staged(rest, root, "b", "job-1"), root, "b", "dropped")


@query(
    f"""WITH l AS (SELECT item FROM ({I.REPLIES}) WHERE {I.SQL_OUTCOME} NOT IN ('ok', 'not_found'))
        SELECT 'b' AS job_type, 'job-1' AS job_id, CAST(ntile(8) OVER (ORDER BY item) - 1 AS INTEGER) AS part,
          CAST(item AS VARCHAR) AS item, CAST(5 AS DOUBLE) AS retry_after_seconds FROM l"""
)
def resume_roundtrip(spark, sf_dir):
    """The items left over, split into eight parts, saved twice and loaded."""
    root = scratch_path(spark, "resume")
    left = classify(I.replies(spark, sf_dir)).where("outcome NOT IN ('ok', 'not_found')").select("item")
    parts = numbering.split_even(left, 8, ["item"])
    for _ in range(2):
        resume.save_resume(resume.resume_rows(parts, "item", "b", "job-1", 5.0, I.STAMP), root)
    return resume.load_resume(spark, root, "b", "job-1").select(
        "job_type", "job_id", "part", "item", "retry_after_seconds"
    )


@query("SELECT lang, count(*) AS record_count, true AS has_bytes FROM documents GROUP BY 1")
def file_stats(spark, sf_dir):
    """Rows and bytes per file, added up per folder."""
    path = scratch_path(spark, "stats")
    tables.write_partitioned(I.table(spark, sf_dir, "documents").select("doc_id", "lang"), path, ["lang"])
    stats = files.file_stats(spark, path)
    lang = F.regexp_extract("file_path", "lang=([a-z]+)", 1).alias("lang")
    return stats.groupBy(lang).agg(
        F.sum("record_count").alias("record_count"), (F.min("bytes") > 0).alias("has_bytes")
    )


def _document_table(spark, sf_dir, name):
    path = scratch_path(spark, name)
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return path, docs


@query("SELECT lang, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def ensure_table(spark, sf_dir):
    """A table created over a folder, created again without effect, and read by name."""
    path, docs = _document_table(spark, sf_dir, "catalog")
    name = "t_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        registry.ensure_table(spark, name, docs.schema, ["lang"], path)
    tables.write_partitioned(docs, path, ["lang"])
    registry.refresh_table(spark, name, ["lang"], files.list_files(spark, path))
    return spark.table(name).groupBy("lang").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))


@query(
    """SELECT CAST(CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS BIGINT) AS snapshot_id, count(*) AS record_count
        FROM documents GROUP BY 1"""
)
def register_files(spark, sf_dir):
    """Files that arrive later come under the next snapshot; files seen before are not entered again."""
    path, docs = _document_table(spark, sf_dir, "register")
    ledger = scratch_path(spark, "ledger")
    for part in ("lang = 'en'", "lang <> 'en'"):
        tables.append(docs.where(part), path, ["lang"])
        registry.register(spark, ledger, "documents", path, I.STAMP)
    rows = registry.read_ledger(spark, ledger)
    return rows.groupBy("snapshot_id").agg(F.sum("record_count").alias("record_count"))


@query(
    """SELECT t AS table_name, CAST(0 AS BIGINT) AS registered, CAST(1 AS BIGINT) AS snapshot_id, n AS record_count
        FROM (SELECT 'docs' AS t, count(*) AS n FROM documents UNION ALL
              SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events)"""
)
def sync_idempotent(spark, sf_dir):
    """Three tables synchronised twice: the second time registers nothing."""
    base = scratch_path(spark, "sync")
    tag = base.rsplit("-", 1)[1]
    sources = {
        "docs": I.table(spark, sf_dir, "documents").select("doc_id", "lang"),
        "orders": I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
        "events": I.table(spark, sf_dir, "events").select("event_id", "event_type"),
    }
    known = []
    for name, df in sources.items():
        by = df.columns[-1:]
        tables.write_partitioned(df, f"{base}/{name}", by)
        known.append((f"{name}_{tag}", f"{base}/{name}", df.schema, by))
    registry.sync(spark, f"{base}/ledger", known, I.STAMP)
    second = registry.sync(spark, f"{base}/ledger", known, I.STAMP)
    totals = registry.read_ledger(spark, f"{base}/ledger").groupBy("table_name").agg(
        F.sum("record_count").alias("record_count")
    )
    return second.join(totals, "table_name").withColumn("table_name", F.substring_index("table_name", "_", 1))


def _events_stream(spark, sf_dir, batch_files=None):
    schema = I.table(spark, sf_dir, "events").schema
    # The trailing star also lets a table of one single file be read as a stream.
    return streams.stream_new(spark, f"{sf_dir}/events.parquet*", schema, batch_files)


@query("SELECT event_type, count(*) AS rows, max(event_id) AS newest FROM events GROUP BY 1")
def stream_new_rows(spark, sf_dir):
    """All arrived files once; a restart adds nothing."""
    base = scratch_path(spark, "stream-new")
    schema = I.table(spark, sf_dir, "events").select("event_id", "event_type").schema

    def step(batch, batch_id):
        tables.append(batch.select("event_id", "event_type"), f"{base}/out")

    for _ in range(2):
        streams.run_to_end(_events_stream(spark, sf_dir), step, f"{base}/checkpoint")
    rows = parquet.scan(spark, f"{base}/out", schema)
    return rows.groupBy("event_type").agg(F.count("*").alias("rows"), F.max("event_id").alias("newest"))


@query(f"SELECT DISTINCT puuid, match_id FROM ({I.ID_LIST})")
def stream_dedup(spark, sf_dir):
    """Ids appended once each, though two streams deliver them all."""
    base = scratch_path(spark, "stream-dedup")
    schema = I.id_list(spark, sf_dir).select("puuid", "match_id").schema
    ids = _events_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("puuid"), F.get_json_object("props", "$.k").alias("match_id")
    )
    step = streams.append_unseen(f"{base}/out", schema, ["puuid", "match_id"])
    for name in ("first", "second"):
        streams.run_to_end(ids, step, f"{base}/{name}")
    return parquet.scan(spark, f"{base}/out", schema)


@query(
    f"""SELECT puuid, CASE WHEN puuid IN (SELECT CAST(user_id AS VARCHAR) FROM events
          WHERE event_type = 'purchase' AND value > 60) THEN {I.SQL_AS_OF} ELSE last_read END AS last_read
        FROM ({I.PLAYER_STATE})"""
)
def stream_state(spark, sf_dir):
    """Read dates moved by arriving purchases."""
    base = scratch_path(spark, "stream-state")
    state = hashing.assign_shard(I.player_state(spark, sf_dir), "puuid")
    tables.write_state(state, f"{base}/state", "000")
    done = (
        _events_stream(spark, sf_dir)
        .where((F.col("event_type") == "purchase") & (F.col("value") > 60))
        .select(F.col("user_id").cast("string").alias("puuid"))
    )
    values = {"last_read": F.lit(I.AS_OF).cast("date")}
    step = streams.mark_state(f"{base}/state", state.schema, "puuid", values)
    streams.run_to_end(done, step, f"{base}/checkpoint")
    return tables.newest_state(spark, f"{base}/state", state.schema).select("puuid", "last_read")


@query(
    f"""SELECT puuid, CASE WHEN puuid IN (SELECT CAST(user_id AS VARCHAR) FROM events
          WHERE event_type = 'purchase' AND value > 60) THEN {I.SQL_AS_OF} ELSE last_read END AS last_read
        FROM ({I.PLAYER_STATE})"""
)
def stream_state_shards(spark, sf_dir):
    """Read dates moved by arriving purchases, where a batch rewrites only the shards that it touches."""
    base = scratch_path(spark, "stream-shards")
    state = hashing.assign_shard(I.player_state(spark, sf_dir), "puuid")
    tables.write_state(state, f"{base}/state", "000")
    done = (
        _events_stream(spark, sf_dir)
        .where((F.col("event_type") == "purchase") & (F.col("value") > 60))
        .select(F.col("user_id").cast("string").alias("puuid"))
    )
    values = {"last_read": F.lit(I.AS_OF).cast("date")}
    step = streams.mark_shards(f"{base}/state", state.schema, "puuid", values, SHARDS)
    streams.run_to_end(done, step, f"{base}/checkpoint")
    return versions.read_shards(spark, f"{base}/state", state.schema).select("puuid", "last_read")


@query("SELECT 'events' AS table_name, CAST(1 AS BIGINT) AS snapshot_id, count(*) AS record_count FROM events")
def stream_register(spark, sf_dir):
    """Arriving files entered into the ledger, once."""
    base = scratch_path(spark, "stream-register")
    arrivals = _events_stream(spark, sf_dir).select("_metadata.file_path", "_metadata.file_size")
    step = streams.register_arrivals(f"{base}/ledger", "events", I.STAMP)
    for name in ("first", "second"):
        streams.run_to_end(arrivals, step, f"{base}/{name}")
    rows = registry.read_ledger(spark, f"{base}/ledger")
    return rows.groupBy("table_name", "snapshot_id").agg(F.sum("record_count").alias("record_count"))


@query(
    f"""SELECT s AS shard_id, count(puuid) AS rows FROM (SELECT CAST(range AS INTEGER) AS s FROM range(4))
        LEFT JOIN (SELECT puuid, {I.sql_shard("puuid")} AS shard_id FROM ({I.PLAYER_STATE}) WHERE last_read IS NULL)
        ON s = shard_id GROUP BY s"""
)
def state_roundtrip(spark, sf_dir):
    """Shards of the newest complete run, with the empty ones, after a second run replaced the first."""
    root = scratch_path(spark, "state")
    rows = hashing.assign_shard(I.player_state(spark, sf_dir), "puuid")
    tables.write_state(rows, root, "2024-01-24")
    tables.write_state(rows.where("last_read IS NULL"), root, "2024-01-25")
    return summary.shard_counts(tables.newest_state(spark, root, rows.schema))
