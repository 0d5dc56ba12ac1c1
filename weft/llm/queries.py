"""The queries opN_<name> over the driver's tables: each applies its operator to a whole table and
derives the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontam, jaccard, langid, licenses, packing, secrets, spelling, suffix_dedup, token_files, topk, turns, urls, warc
from weft.llm.common import scratch, spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(spread(docs), secrets.train(secrets.labelled_samples(docs)))
    kinds = "array('" + "','".join(secrets.KINDS) + "')"
    joined = lambda spans: F.expr(f"array_join(transform({spans}, s -> concat(element_at({kinds}, s.kind + 1), ':', s.start, ':', s.end)), ',')")
    count = lambda kind: F.expr(f"cast(size(filter(secret_spans, s -> s.kind = {kind})) as bigint)")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined("filter(secret_spans, s -> s.kind < 3)"), 256).alias("base_sha256"), joined("secret_spans").alias("spans"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid_held_out())
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.identify(spread(docs), model, ["doc_id", "held_out"]).drop("known")


def langid_held_out():
    """True where crc32 of the id as text leaves 1 modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), ["doc_id"], word_tokenizer())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding")


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, word_tokenizer())
    return token_files.read(spark, path)


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLE_SQL["op9_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
"""


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched_words", "span_words")


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"), n=4, percent=85, links=True)


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), min_bytes=50)


BATCHES = 12


@query
def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter("turn is not null")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.col("turn").cast("string"))
    rows = rows.withColumn("h", F.conv(F.left(F.sha2(key, 256), F.lit(8)), 16, 10).cast("long"))
    once = rows.withColumn("batch", F.col("h") % BATCHES)
    again = rows.filter("h % 7 < 2").withColumn("role", F.lit("user")).withColumn("batch", (F.col("h") + 5) % BATCHES)
    found = turns.replay(once.unionByName(again), BATCHES)
    digest = F.when(F.col("event") == "close", F.sha2("waiting", 256)).otherwise(F.sha2(F.concat("role", F.lit("|"), "text"), 256))
    return found.select("event", digest.alias("sha256"), "conv_id", "turn", "batch", "n_missing", "n_breaks")


ORACLE_SQL["op11_turns"] = """
WITH named AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, min(turn) OVER (PARTITION BY conv_id) AS first,
    CAST('0x' || left(sha256(coalesce(CAST(conv_id AS VARCHAR), '') || ':' || CAST(turn AS VARCHAR)), 8) AS BIGINT) AS h
  FROM conversations WHERE turn IS NOT NULL
), fed AS (
  SELECT conv_id, turn, first, role, role || '|' || text AS payload, h % 12 AS batch FROM named
  UNION ALL SELECT conv_id, turn, first, 'user', 'user|' || text, (h + 5) % 12 FROM named WHERE h % 7 < 2
), arrived AS (
  SELECT * FROM fed QUALIFY row_number() OVER (PARTITION BY conv_id, turn, batch ORDER BY payload, role) = 1
), seen AS (
  SELECT conv_id, batch, lead(batch) OVER (PARTITION BY conv_id ORDER BY batch) AS later FROM (SELECT DISTINCT conv_id, batch FROM arrived)
), closed AS (
  SELECT conv_id, least(min(batch) + 2, 12) AS closes FROM seen WHERE later IS NULL OR later - batch > 2 GROUP BY conv_id
), judged AS (
  SELECT a.*, closes FROM arrived a JOIN closed c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
), kept AS (
  SELECT * FROM judged WHERE batch <= closes QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY batch) = 1
), placed AS (
  SELECT *, turn - first = row_number() OVER w - 1 AS gapless, max(batch) OVER w AS ready, lag(turn) OVER w AS before, lag(role) OVER w AS role_before
  FROM kept WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
)
SELECT 'release' AS event, sha256(payload) AS sha256, conv_id, turn, ready AS batch, NULL::BIGINT AS n_missing, NULL::BIGINT AS n_breaks FROM placed WHERE gapless
UNION ALL SELECT 'reject', sha256(payload), conv_id, turn, batch, NULL, NULL FROM judged WHERE batch > closes
UNION ALL SELECT 'close', sha256(coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (NOT gapless), '')), conv_id, -1, any_value(closes),
  max(turn) - any_value(first) + 1 - count(*), count(*) FILTER (before = turn - 1 AND role = role_before) FROM placed GROUP BY conv_id
"""


#: The rules of op12.
RULES = (urls.Rule("net", "/", False), urls.Rule("example.net", "/en/", True), urls.Rule("example.com", "/de/", False), urls.Rule("org", "/fr/", True))


@query
def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url"))
    return urls.judge(pages, urls.train(urls.ruled_urls(pages, RULES)), RULES, ["page_id"])


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), typo_every=97))


ORACLE_SQL["op1_suffix_dedup"] = r"""
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), places AS (
  SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM raw)
), earlier AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) < doc_id AS gone FROM places
), runs AS (
  SELECT doc_id, i, i > lag(i) OVER w + 50 OR lag(i) OVER w IS NULL AS new FROM earlier WHERE gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT doc_id, i, count(*) FILTER (new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM runs
), removed AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, k
), kept AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY b) AS z FROM (SELECT doc_id, a, b FROM removed UNION ALL SELECT doc_id, 0, 0 FROM raw)
), texts AS (
  SELECT r.doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (coalesce(z, n) - a) AS BIGINT)), '' ORDER BY a) AS t FROM raw r JOIN kept k ON r.doc_id = k.doc_id GROUP BY r.doc_id
), sums AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM removed GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256 FROM raw LEFT JOIN sums USING (doc_id) JOIN texts USING (doc_id)
"""


ORACLE_SQL["op5_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT doc_id, coalesce((SELECT n FROM sizes s WHERE s.doc_id = d.doc_id), 0) AS n_shingles, (SELECT min(b) FROM reached r WHERE r.a = d.doc_id) AS component_id, (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links FROM documents d
"""


ORACLE_SQL["op8_warc"] = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages
), b AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS INTEGER)) AS fives, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS letters FROM p
)
SELECT page_id, payload_bytes, array_to_string(list_transform(fives, lambda v: letters[(v >> 15) + 1] || letters[((v >> 10) & 31) + 1] || letters[((v >> 5) & 31) + 1] || letters[(v & 31) + 1]), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM b
"""
