"""The corpus pipeline: quality filter, exact dedup, near dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next one.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumbre.llm.bpe_trie import encode_decode
from lumbre.llm.decontaminate import decontaminate
from lumbre.llm.exact_dedup import exact_dedup
from lumbre.llm.near_dedup import near_dedup
from lumbre.llm.quality import filter_quality
from lumbre.llm.shared import documents, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated), ("bpe", encode)]

#: SQL expresses neither the classifier nor the tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
