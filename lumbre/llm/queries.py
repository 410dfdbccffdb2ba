"""The queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import arc_warc, bpe_trie, decontaminate, exact_dedup, language_crf, line_dedup, near_dedup, quality, substring_dedup, token_store
from .shared import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_crf.identify(docs, language_crf.fit(docs))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("text_hash")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("mark")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_tokens(token_store.write_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = arc_warc.read_warc(arc_warc.arc_to_warc(arc_warc.pages_to_arc(pages)))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_language_id, op2_decontamination, op3_line_dedup, op4_bpe, op5_quality, op6_token_output, op7_near_dedup, op8_exact_dedup, op9_warc, op10_substring_dedup, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontaminate.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op7_near_dedup": near_dedup.ORACLE,
        "op8_exact_dedup": exact_dedup.ORACLE, "op9_warc": arc_warc.ORACLE, "op10_substring_dedup": substring_dedup.ORACLE,
    }
