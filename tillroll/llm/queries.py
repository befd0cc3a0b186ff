"""Registered queries of the subpackage: name -> fn(spark, sf_dir), and the
DuckDB text of those that SQL can state. Each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import conversations, decontaminate, html_text, jaccard, near_vectors, neighbours, quality, substrings, toxicity, warc, whitening
from tillroll.llm.byte_bpe import round_trip
from tillroll.llm.storage import new_folder
from tillroll.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.remainder("doc_id", 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~held_out)
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.remainder("doc_id", 5) == 0
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), chain)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).select(
        F.expr("try_cast(page_id AS BIGINT)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr("try_cast(refers_to AS BIGINT)").alias("refers_to"))


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per removed span: its document, words ``first_word`` to ``end_word`` (exclusive), and an earlier document with it."""
    spans = substrings.repeated_spans(table(spark, sf_dir, "documents"))
    return (spans.select("key", F.explode(F.arrays_zip("start", "end", "earlier")).alias("s"))
            .select(F.col("key").alias("doc_id"), F.col("s.start").alias("first_word"), F.col("s.end").alias("end_word"),
                    F.col("s.earlier").alias("earlier_doc_id")))


@query
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_shingles", "component_id")


@query
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage of a document that aligns with a benchmark item."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "score",
                        F.col("start").alias("first_word"), F.col("end").alias("end_word"))


@query
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.links(table(spark, sf_dir, "embeddings"), 0.95)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact value is beyond a long."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), k=8)
    return white.select(F.col("id").alias("vec_id"), "component", "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
                        "whitened", "explained", "identity_error")


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.repair(conversations.damage(rows))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("key")), "left")
            .select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


ORACLE["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h FROM p),
named AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id,
                 array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INT), 5) AS INT) >> (5 * (3 - CAST(i % 4 AS INT)))) & 31), 1)), '')
                 AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named"""

ORACLE["op7_jaccard"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 75 * (nx.n + ny.n - shared)),
r(doc_id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.to_id = l.x)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(to_id) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


def _sql_add(state: str, cost: int, letter: str) -> str:
    """SQL of a value (nine digits of cost, then the audit) after one more edit."""
    return f"lpad(CAST(CAST(left({state}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({state}, 10)"


def _sql_step(state: str, keeps: str, forced: str) -> str:
    """SQL of the best value of a grammar state before row r, inserts left out."""
    return (f"least({_sql_add('f.' + state, 4, 'D')}, CASE {keeps} END, "
            f"CASE WHEN NOT gone THEN CASE WHEN cut THEN {_sql_add('f.' + forced, 6, 'R')} ELSE {_sql_add('f.' + forced, 3, 'R')} END END)")


def _sql_keep(initial: str, state: str) -> str:
    return (f"WHEN NOT gone AND ini = '{initial}' THEN CASE WHEN cut THEN {_sql_add('f.' + state, 3, 'K')} ELSE {_sql_add('f.' + state, 0, 'K')} END")


# The values run backwards over each conversation's rows, one column a grammar state (b start, s after system,
# u after user, a after assistant); the edits are then replayed forwards.
ORACLE["op13_conversations"] = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda e, z: CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END)), 4294967295) % 20 AS h FROM given),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (VALUES (1), (2)) AS t(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS r,
    CASE WHEN role = '' THEN ' ' ELSE left(role, 1) END AS ini FROM damaged),
marked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY r) AS nth, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS is_blank,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open_end, lag(ini) OVER (PARTITION BY conv_id ORDER BY r) AS before FROM ranked),
sym AS (SELECT *, is_blank OR nth > 1 AS gone, NOT is_blank AND nth = 1 AND open_end AS cut FROM marked),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
    count(*) FILTER (NOT is_blank AND nth > 1) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(r) AS n FROM sym GROUP BY conv_id),
f AS (SELECT conv_id, n AS r, '000000000' AS b, '000000006II' AS s, '000000003I' AS u, '000000000' AS a FROM counts
  UNION ALL
  SELECT conv_id, r, least(b0, {_sql_add('least(u0, ' + _sql_add('a0', 3, 'I') + ')', 3, 'I')}),
         least(s0, {_sql_add('least(u0, ' + _sql_add('a0', 3, 'I') + ')', 3, 'I')}), least(u0, {_sql_add('a0', 3, 'I')}), least(a0, {_sql_add('u0', 3, 'I')})
  FROM (SELECT f.conv_id, f.r - 1 AS r, {_sql_step('b', _sql_keep('s', 's') + ' ' + _sql_keep('u', 'u'), 'u')} AS b0,
               {_sql_step('s', _sql_keep('u', 'u'), 'u')} AS s0, {_sql_step('u', _sql_keep('a', 'a'), 'a')} AS u0,
               {_sql_step('a', _sql_keep('u', 'u'), 'u')} AS a0
        FROM f JOIN sym ON sym.conv_id IS NOT DISTINCT FROM f.conv_id AND sym.r = f.r)),
best AS (SELECT counts.* EXCLUDE (n), CAST(left(b, 9) AS BIGINT) AS cost, substr(b, 10) AS audit
  FROM counts JOIN f ON f.conv_id IS NOT DISTINCT FROM counts.conv_id AND f.r = 0),
edits AS (SELECT conv_id, i, substr(audit, i, 1) AS e, count(*) FILTER (substr(audit, i, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS r
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM best)),
kept AS (SELECT edits.conv_id, i, e, role, text, row_number() OVER (PARTITION BY edits.conv_id ORDER BY i) AS place,
    first_value(e = 'K' AND ini = 's') OVER (PARTITION BY edits.conv_id ORDER BY i) AS opened
  FROM edits LEFT JOIN sym ON e <> 'I' AND sym.conv_id IS NOT DISTINCT FROM edits.conv_id AND sym.r = edits.r WHERE e <> 'D'),
lines AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (place - CAST(opened AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS h FROM kept GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM c.conv_id"""
