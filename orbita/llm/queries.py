"""Registered queries of the training-text operators, and the SQL of those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from . import (chat, common, decontaminate, divergence, hard_negatives, html_crf, line_dedup, packing, quality, sharding, simhash,
               token_store, toxicity, weak_rules)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir), shingle=3, radius=2)


@register("op2_html_extraction", html_crf.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(common.table(spark, sf_dir, "pages"))


@register("op3_decontamination", decontaminate.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


@register("op4_token_store")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_store(common.documents(spark, sf_dir), path, tokenizer_path(), shuffle_partitions(spark))
    return token_store.read_store(spark, path)


@register("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir), tokenizer_path())


@register("op6_line_dedup", line_dedup.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(common.documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


@register("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(common.documents(spark, sf_dir))


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


@register("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judge(common.documents(spark, sf_dir))


@register("quality_base_counts", weak_rules.BASE_ORACLE)
def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the quality rules start from, without the rules."""
    rows = weak_rules.counted(common.documents(spark, sf_dir))
    return rows.select("doc_id", *weak_rules.BASE, weak_rules.base_failed().alias("base_failed"))


@register("op10_chat_formatting")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(common.table(spark, sf_dir, "conversations"))


@register("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


@register("op12_source_divergence", divergence.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.documents(spark, sf_dir))


@register("op13_hard_negatives", hard_negatives.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 first get the next label of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(common.table(spark, sf_dir, "embeddings"), label)
