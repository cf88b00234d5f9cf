"""The dealt operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wrenchline.llm import (
    byte_bpe, chat, decontamination, forced_bpe, line_dedup, ngram_join, pii, prefix_trie, quality, substring_dedup, topk, warc,
    whitening,
)
from wrenchline.llm.common import table
from wrenchline.shipping import ship_package


def vocabulary() -> tuple[str, str]:
    """File of the ranks and the pattern of pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return byte_bpe.digest(table(spark, sf_dir, "documents"), *vocabulary())


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.digest(table(spark, sf_dir, "documents"), spark)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return substring_dedup.digest(table(spark, sf_dir, "documents"), spark)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"), spark)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return topk.digest(table(spark, sf_dir, "embeddings"), spark)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spark)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.drill(table(spark, sf_dir, "pages"), spark)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return whitening.digest(table(spark, sf_dir, "embeddings"), spark)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_trie.digest(table(spark, sf_dir, "conversations"), spark)


def op13_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship_package(spark)
    return forced_bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_byte_bpe, op3_ngram_join, op4_line_dedup, op5_substring_dedup,
        op6_chat_format, op7_topk, op8_quality, op9_decontamination, op10_warc,
        op11_whitening, op12_prefix_trie, op13_forced_bpe,
    )
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_chat_format": chat.ORACLE,
    "op7_topk": topk.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op10_warc": warc.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
