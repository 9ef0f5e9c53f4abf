"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklake.llm import audit, chat, counts, exact, langid, manifest, mixing, packing, passages, simhash, topk, toxicity, warc
from ranklake.session import scratch_path
from ranklake.workload import Registry

query = Registry()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

_MIX = rf"""
WITH best AS (SELECT doc_id AS id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
      / (CASE WHEN quality = 1 THEN 2.0 WHEN quality = 0 THEN 0.5 ELSE 1.0 END)::DOUBLE AS draw
  FROM documents LEFT JOIN best ON doc_id = id),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM totals),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level FROM ranked
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    least(cap, coalesce(max(CASE WHEN level <= cap / weight THEN level END) OVER () * weight, cap)) AS target FROM leveled),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
    round(target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size)::BIGINT AS budget FROM targets),
placed AS (
  SELECT s.doc_id, s.size, b.*, coalesce(sum(s.size) OVER (PARTITION BY b.source ORDER BY s.draw, s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source, source_size, target, epochs,
  greatest(0, least(size, budget - earlier))::BIGINT AS extra,
  (epochs * size + greatest(0, least(size, budget - earlier)))::BIGINT AS taken
FROM placed
"""


@query(_MIX)
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), quality=table(spark, folder, "labels"))


_TOP_K = """
WITH usable AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query(_TOP_K)
def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


_B32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({0} >> {1}) & 31) + 1, 1)"
_FIVE = "('0x' || substr(sha1(coalesce(html, '')), {0}, 5))::BIGINT"
_DIGEST = " || ".join(_B32.format(_FIVE.format(5 * i + 1), s) for i in range(8) for s in (15, 10, 5, 0))
_WARC = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, {_DIGEST} AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN keep IS NULL OR page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to FROM k
"""


@query(_WARC)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives, compression="gzip")
    return warc.page_records(spark, archives)


_CONTROL = r"([<\[])(\\*)(\|turn\|>|\|text\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])"
_ESC = r"regexp_replace(coalesce({0}, ''), '" + _CONTROL + r"', '\1\\\2\3', 'g')"
_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
parts AS (
  SELECT *, row_number() OVER w AS seq, lead(1) OVER w IS NULL AS final,
    sum(length('<|turn|><|text|><|end|>' || {_ESC.format('role')} || {_ESC.format('text')})) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY seq)) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR final THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id
"""


@query(_CHAT)
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.expand(rows.unionByName(planted)))


_EXACT = rf"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


@query(_EXACT)
def op7_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_copies(table(spark, folder, "documents"), digest_all=True)


@query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query()
def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.learn(docs))


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")))


@query()
def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query()
def op11_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.count_tokens(table(spark, folder, "documents"))


_AUDIT = rf"""
WITH said AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
judged AS (
  SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails
  FROM said),
marks AS (SELECT doc_id AS id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged LEFT JOIN marks ON doc_id = id GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b | w.b | x.b | y.b | z.b = 31),
steps AS (
  SELECT filter_order, s::INT AS step, bits[s] AS own, coalesce(list_sum(bits[1 : s - 1]), 0)::INT AS gone
  FROM orders, range(1, 6) r(s)),
told AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (fails & (gone | own) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & own > 0 AND fails & gone = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & own > 0 AND fails & gone > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & own > 0 AND fails & gone = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & own > 0 AND fails & gone = 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM told
"""


@query(_AUDIT)
def op12_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))) + ")"
_CLAIM = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", f"translate(text, '{_UPPER}', '{_LOWER}')"))) + ")"
_BESIDE = """
    coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
    coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a"""
_MANIFEST = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN tampered THEN claim ELSE leaf END AS claim,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM (SELECT doc_id, lang, {_LEAF} AS leaf, {_CLAIM} AS claim,
    coalesce(xor(list_reduce([unicode(d)::BIGINT FOR d IN string_split(doc_id::VARCHAR, '')],
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 3 = 0, false) AS tampered
    FROM documents, crc)),
nodes AS (
  SELECT 0 AS level, lang, rank AS idx, leaf AS hash FROM leaves UNION ALL
  SELECT level + 1, lang, idx // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes) WHERE n > 1 GROUP BY level, lang, idx // 8),
ends AS (SELECT *, max(level) OVER (PARTITION BY lang) AS last FROM nodes),
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM ends WHERE level = last),
tops AS (
  SELECT 0 AS level, rank AS idx, hash FROM subroots UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(hash, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, idx // 8),
low AS (SELECT level, lang, idx, {_BESIDE} FROM ends WHERE level < last WINDOW run AS (PARTITION BY lang, level, idx // 8 ORDER BY idx)),
high AS (
  SELECT level, idx, {_BESIDE} FROM tops WHERE level < (SELECT max(level) FROM tops)
  WINDOW run AS (PARTITION BY level, idx // 8 ORDER BY idx)),
steps AS (
  SELECT doc_id, leaf, leaves.lang, rank, level, b, a FROM leaves JOIN low
    ON low.lang IS NOT DISTINCT FROM leaves.lang AND idx = rank >> (3 * level)
  UNION ALL
  SELECT doc_id, leaf, leaves.lang, leaves.rank, 100 + level, b, a FROM leaves
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang JOIN high ON idx = s.rank >> (3 * level)),
paths AS (
  SELECT lang, rank, sha256(string_agg(b || a, '' ORDER BY level)) AS proof_sha256,
    list({{'b': b, 'a': a, 'h': ''}} ORDER BY level) AS path FROM steps GROUP BY lang, rank),
told AS (
  SELECT doc_id, leaf, s.hash AS subroot, (SELECT hash FROM tops ORDER BY level DESC LIMIT 1) AS root,
    coalesce(proof_sha256, sha256('')) AS proof_sha256,
    coalesce(list_reduce(path, lambda x, y: {{'b': '', 'a': '', 'h': sha256(y.b || x.h || y.a)}}, {{'b': '', 'a': '', 'h': claim}}).h, claim) AS folded_root
  FROM leaves JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang
  LEFT JOIN paths ON paths.lang IS NOT DISTINCT FROM leaves.lang AND paths.rank = leaves.rank)
SELECT *, folded_root = root AS verified FROM told
"""


@query(_MANIFEST)
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    # Every third document is checked as if its capitals had been lost.
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    found = manifest.manifest(table(spark, folder, "documents"), claimed={"text": lowered})
    told = found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest().alias("proof_sha256"),
        manifest.folded(F.coalesce("claimed_leaf", "leaf")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
