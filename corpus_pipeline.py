"""A corpus from documents: good quality, no exact or near copies, no benchmark items, as token ids.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Null texts count
as empty throughout; extra columns of documents are carried along until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parlance.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from parlance.llm.common import written
from parlance.llm.queries import VOCABULARY, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, without_id=True)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality", good_quality), ("exact_dedup", exact_copies), ("ngram_join", near_copies), ("decontaminate", benchmark_items), ("bpe", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs


#: The quality stage is a fitted model, which SQL can't express.
ORACLE_SQL = None
