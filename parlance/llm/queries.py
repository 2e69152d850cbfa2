"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, exact_dedup, language, lexical, ngram_join, pii, quality, spelling, substrings, token_counts, url_filter, warc

VOCABULARY = "byte_bpe_50k.json"

#: The dated list of op9: (list, key, action, day).
URL_EVENTS = [
    ("gambling", "casino-win.example.com", "add", "2024-01-15"),
    ("gambling", "casino-win.example.net", "add", "2024-02-01"),
    ("gambling", "casino-win.example.net", "remove", "2024-08-01"),
    ("gambling", "casino-win.example.net", "add", "2024-10-10"),
    ("gambling", "casino-win.example.org", "add", "2024-03-01"),
    ("pharmacy", "cheap-pills.example.com", "add", "2024-01-01"),
    ("pharmacy", "cheap-pills.example.net", "add", "2024-04-20"),
    ("pharmacy", "cheap-pills.example.net", "remove", "2024-12-01"),
    ("pharmacy", "cheap-pills.example.org", "add", "2023-06-01"),
    ("adult", "adult-x.example.com", "add", "2023-01-01"),
    ("adult", "adult-x.example.com", "remove", "2024-03-03"),
    ("adult", "adult-x.example.com", "add", "2024-05-05"),
    ("adult", "adult-x.example.net", "add", "2024-02-10"),
    ("adult", "adult-x.example.org", "add", "2024-02-10"),
    ("sections", "tionsh.example.net/fr", "add", "2024-06-01"),
    ("sections", "tionsh.example.net/fr", "remove", "2024-07-01"),
    ("sections", "blog.tionsh.example.net/de", "add", "2024-05-01"),
    ("sections", "ththth.example.org/de", "add", "2024-09-01"),
    ("hosts", "tionble.example.com", "add", "2024-11-01"),
    ("hosts", "ththth.example.org", "add", "2024-04-01"),
    ("hosts", "ththth.example.org", "remove", "2024-04-15"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.createDataFrame(URL_EVENTS, "list string, key string, action string, at string").withColumn("at", F.to_date("at"))
    captures = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")).alias("fetched"))
    return url_filter.filtered(captures, events).withColumn("fetched", F.col("fetched").cast("string"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents"), check_digits=True)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_bpe, op3_token_counts, op4_quality, op5_ngram_join, op6_language, op7_warc, op8_decontaminate, op9_url_filter, op10_pii, op11_lexical_search, op12_substring_dedup, op13_spelling_variants)}

URL_SQL = """
WITH events(list, key, action, day) AS (VALUES %s),
     changes AS (SELECT *, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM events),
     active AS (SELECT list, key, CAST(day AS DATE) AS since, CAST(until AS DATE) AS until FROM changes WHERE action = 'add'),
     captures AS (
         SELECT page_id, url, DATE '2024-01-01' + CAST(page_id %% 366 AS INTEGER) AS fetched,
                lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
                lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)', 1)) AS path
         FROM pages),
     hits AS (
         SELECT c.page_id, a.list, a.key,
                row_number() OVER (PARTITION BY c.page_id ORDER BY length(a.key) DESC, a.list) AS r
         FROM captures c JOIN active a
           ON c.fetched >= a.since AND (a.until IS NULL OR c.fetched < a.until)
          AND (c.host = a.key OR ends_with(c.host, '.' || a.key) OR starts_with(c.host || '/' || c.path || '/', a.key || '/')))
SELECT c.page_id, c.host, CAST(c.fetched AS VARCHAR) AS fetched, h.page_id IS NOT NULL AS blocked, h.list, h.key
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.r = 1
""" % ", ".join(str(e) for e in URL_EVENTS)

ORACLE_SQL = {"op1_exact_dedup": exact_dedup.ORACLE_SQL, "op7_warc": warc.ORACLE_SQL, "op9_url_filter": URL_SQL, "op11_lexical_search": lexical.ORACLE_SQL, "op12_substring_dedup": substrings.ORACLE_SQL, "op13_spelling_variants": spelling.ORACLE_SQL}
