"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, conversations, decontaminate, line_dedup, maxent_lm, mixing, ngram_join, quality_rules, secrets, sharding, toxicity, url_filter, whitening
from .base import held_out, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.score(docs, model).select("_row.doc_id", held_out(F.col("_row.doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, trees).select("_row.doc_id", *quality_rules.BASE, "base_failed", "kept", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).select("_row.doc_id", *[f"p_{c}" for c in toxicity.CATEGORIES], "toxic")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=(9, 10))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", "n_lines", "n_dropped", "kept_sha256")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_digest(table(spark, sf_dir, "conversations"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_classifier, op2_quality_rules, op3_toxicity, op4_decontamination, op5_ngram_join, op6_line_dedup, op7_url_filters, op8_mixing, op9_secret_scan, op10_lm_scoring, op11_conversation_repair, op12_sharding, op13_whitening)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every window of every text against every window of every item. Windows that follow one another in both are one
#: longer match.
OVERLAPS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
i AS (SELECT bid, item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
iw AS (SELECT bid, item, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM i)),
dw AS (SELECT rid, k, j, array_to_string(w[j:j + k - 1], ' ') AS s FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS j FROM d JOIN (SELECT DISTINCT k FROM i) ks ON len(w) >= k)),
h AS (SELECT rid, bid, item, dw.k, j, i FROM dw JOIN iw ON dw.k = iw.k AND dw.s = iw.s),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(j, j + k)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid),
m AS (SELECT rid, item, min(j) AS j, min(i) AS i, k + count(*) - 1 AS size FROM (SELECT *, j - row_number() OVER (PARTITION BY rid, bid, j - i ORDER BY j) AS island FROM h) GROUP BY rid, bid, item, k, j - i, island),
l AS (SELECT rid, size, j - 1 AS j, item, i - 1 AS i FROM m QUALIFY row_number() OVER (PARTITION BY rid ORDER BY size DESC, j, item, i) = 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
  coalesce(size, 0) AS longest, coalesce(j, -1) AS longest_at, coalesce(l.item, '') AS longest_item, coalesce(l.i, -1) AS longest_item_at
FROM d LEFT JOIN n USING (rid) LEFT JOIN t USING (rid) LEFT JOIN l USING (rid)"""

#: All pairs that share a shingle, then everything that can be reached.
COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OVERLAPS, "op5_ngram_join": COMPONENTS, "op6_line_dedup": line_dedup.ORACLE, "op7_url_filters": url_filter.oracle(), "op9_secret_scan": secrets.oracle(), "op11_conversation_repair": conversations.oracle(), "op12_sharding": sharding.oracle()}
