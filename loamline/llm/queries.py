"""One query for each operator, over its whole table, and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.llm import chat_format, decontaminate, license_scan, pieces, pii, secrets, simhash, topk, toxicity, url_filter
from loamline.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.report(turns.unionByName(chat_format.probe(spark)))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.fit(url_filter.seed_urls(spark)))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_license_scan, op2_chat_format, op3_pii, op4_sentencepiece, op5_decontaminate, op6_toxicity, op7_simhash, op8_secrets, op9_url_filter, op10_topk)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": chat_format.ORACLE,
    "op5_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
sizes AS (SELECT item, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM sizes, LATERAL (SELECT unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS k)),
lengths AS (SELECT DISTINCT n FROM grams),
spots AS (SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS g FROM d, lengths, LATERAL (SELECT unnest(range(1, CAST(greatest(len(w) - n + 2, 1) AS BIGINT))) AS k)),
found AS (SELECT r, spots.n, k, item FROM spots JOIN grams ON spots.g = grams.g AND spots.n = grams.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
""",
    "op8_secrets": secrets.ORACLE,
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(e) AS qe FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(list_zip(qe, e), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM q JOIN v ON v.vec_id <> q.query_id AND len(qe) = len(e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""",
}
