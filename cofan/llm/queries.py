"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofan.llm import bpe, content_sort_dedup, hard_negatives, jaccard_join, language, license_scan, mixing, periodic_runs, pii, topk, toxicity, url_filter, warc
from cofan.llm.common import table


def _fold(modulus: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.annotate(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    shown = mixing.mix(docs)
    return shown.select("row.doc_id", "row.source", "pass", "block", "slot")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup.annotate(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("digest_ok")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


def repeated_tail(words: F.Column, doc_id: F.Column) -> F.Column:
    """The words of op12's input: of one document in ten, word i >= a becomes word
    a + (i - a) % p, with a and p from a hash of the id."""
    h, n = F.crc32(doc_id.cast("string").cast("binary")), F.size(words).cast("long")
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    moved = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + F.pmod(i - a, p)).cast("int"))))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), moved).otherwise(words)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    words = F.when(chosen, F.filter(F.split("text", _SPACE + "+"), lambda w: w != ""))
    split = docs.withColumn("words", words)
    text = F.coalesce(F.array_join(repeated_tail(F.col("words"), F.col("doc_id")), " "), F.col("text"))
    found = periodic_runs.find(split.select("doc_id", text.alias("text")))
    # Greatest length, then smallest start, then smallest period.
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    body = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_max(ranked).alias("top"), F.sha2(body.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select(
        "doc_id", "n_runs", (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.p")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_topk, op2_ngram_jaccard_join, op3_source_mixing, op4_personal_data, op5_bpe,
        op6_exact_dedup, op7_language_id, op8_warc, op9_toxicity, op10_url_filter,
        op11_hard_negatives, op12_periodic_runs, op13_license_scan,
    )
}

_SPACE = r"[ \t\n\x0b\x0c\r]"

SQL: dict[str, str] = {
    "op1_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda w: w <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM d),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(s) AS t FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM e x JOIN e y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n_shingles + y.n_shingles - k)),
c(a, b) AS (SELECT a, b FROM l UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
r AS (SELECT a, min(b) AS low FROM c GROUP BY a),
m AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT n.doc_id, n_shingles, least(n.doc_id, coalesce(low, n.doc_id)) AS component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM n LEFT JOIN r ON r.a = n.doc_id LEFT JOIN m ON m.a = n.doc_id
""",
    "op8_warc": """
WITH p AS (
  SELECT row_number() OVER () AS u, page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (
  SELECT *, first_value(u) OVER w AS last_u, first_value(page_id) OVER w AS last_id FROM p
  WINDOW w AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC NULLS LAST, u))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND u <> last_u THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND u <> last_u THEN last_id END AS refers_to
FROM r
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, q.label AS own, c.vec_id, c.label,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
""",
    "op6_exact_dedup": f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS norm FROM documents),
r AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(norm) AS text_sha256 FROM r
""",
}
