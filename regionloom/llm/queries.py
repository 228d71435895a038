"""Queries of the corpus operators over whole tables, with the SQL of those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionloom.llm import bpe, language_id, neighbours, packing, quality_classifier, quality_rules, secret_scan, simhash, suffix_dedup, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(_table(spark, sf_dir, "documents"))


#: Days over which the captures of ``pages`` are taken to be spread, by page_id: the table has no fetch times.
CAPTURE_DAYS = 366


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries made by rule for the hosts of ``pages`` and for two of their parent domains.

    A host is blocked from the day length * 7 if that and the number of its dots allow, and allowed 90 days later.
    """
    hosts = pages.select(F.expr(f"lower(regexp_extract(url, r'{url_filter.HOST}', 1))").alias("domain")).where("domain <> ''").distinct()
    day = "date_add(DATE'2024-01-01', CAST(length(domain) * 7 % 200 AS INT))"
    made = hosts.where("length(domain) % 3 = 0").selectExpr("domain", f"inline(array(struct('block' AS action, {day} AS dated), struct('allow' AS action, date_add({day}, 90) AS dated)))")
    fixed = pages.sparkSession.sql("SELECT * FROM VALUES ('example.net', 'block', DATE'2024-05-01'), ('example.net', 'allow', DATE'2024-08-01'), ('example.org', 'block', DATE'2024-10-01') AS t(domain, action, dated)")
    return made.unionByName(fixed)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr(f"date_add(DATE'2024-01-01', CAST(page_id % {CAPTURE_DAYS} AS INT))"))
    return url_filter.filter_captures(captures, list_entries(pages)).select("page_id", "host", "matched_domain", "action", "blocked")


OP8_SQL = f"""
WITH c AS (
  SELECT page_id, nullif(rtrim(lower(regexp_extract(url, '{url_filter.HOST}', 1)), '.'), '') AS host,
         DATE '2024-01-01' + CAST(page_id % {CAPTURE_DAYS} AS INTEGER) AS fetched
  FROM pages),
h AS (SELECT DISTINCT lower(regexp_extract(url, '{url_filter.HOST}', 1)) AS domain FROM pages WHERE regexp_extract(url, '{url_filter.HOST}', 1) <> ''),
e AS (
  SELECT domain, 'block' AS action, DATE '2024-01-01' + CAST(length(domain) * 7 % 200 AS INTEGER) AS dated FROM h WHERE length(domain) % 3 = 0
  UNION ALL
  SELECT domain, 'allow', DATE '2024-01-01' + CAST(length(domain) * 7 % 200 AS INTEGER) + 90 FROM h WHERE length(domain) % 3 = 0
  UNION ALL
  SELECT * FROM (VALUES ('example.net', 'block', DATE '2024-05-01'), ('example.net', 'allow', DATE '2024-08-01'), ('example.org', 'block', DATE '2024-10-01')) AS t(domain, action, dated)),
i AS (SELECT domain, action, dated, lead(dated) OVER (PARTITION BY domain ORDER BY dated) AS until FROM (SELECT domain, dated, min(action) AS action FROM e GROUP BY domain, dated)),
m AS (
  SELECT page_id, i.domain, i.action, row_number() OVER (PARTITION BY page_id ORDER BY length(i.domain) DESC) AS n
  FROM c JOIN i ON (c.host = i.domain OR ends_with(c.host, '.' || i.domain)) AND fetched >= dated AND (until IS NULL OR fetched < until))
SELECT c.page_id, c.host, m.domain AS matched_domain, m.action, coalesce(m.action = 'block', FALSE) AS blocked
FROM c LEFT JOIN m ON c.page_id = m.page_id AND m.n = 1
"""


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.score_documents(docs, quality_classifier.fit(docs, _table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_bpe, op2_packing, op3_simhash, op4_neighbours, op5_language, op6_secrets, op7_suffix_dedup, op8_url_filter, op9_quality_classifier, op10_quality_rules)}
ORACLE_SQL: dict[str, str] = {"op8_url_filter": OP8_SQL}
