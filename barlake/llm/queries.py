"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import (
    best_fit,
    bloom_lm,
    exact_dedup,
    filter_audit,
    jaccard_join,
    mixing,
    oracles,
    pivot_topk,
    repeat_index,
    secret_scan,
    site_quality,
    spelling_variants,
    toxicity,
    url_filter,
)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents"))


def op4_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_index.remove_repeats(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.assign(table(spark, sf_dir, "documents"))


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"))


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.assign(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"), rank_file())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pivot_topk": op1_pivot_topk,
        "op2_url_filter": op2_url_filter,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_repeat_index": op4_repeat_index,
        "op5_toxicity": op5_toxicity,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_site_quality": op7_site_quality,
        "op8_bloom_lm": op8_bloom_lm,
        "op9_best_fit": op9_best_fit,
        "op10_mixing": op10_mixing,
        "op11_secret_scan": op11_secret_scan,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
