"""From raw documents to token ids: five stages, each writing what the next one reads.

The classifier cannot be written in SQL, so there is none for the pipeline; tests
hold it against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wrenchline.llm import byte_bpe, decontamination, line_dedup, ngram_join, quality
from wrenchline.llm.common import Stages, table
from wrenchline.llm.queries import vocabulary
from wrenchline.shipping import ship_package


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines stay in one document only."""
    return line_dedup.deduplicated(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return ngram_join.one_per_group(docs, spark)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), spark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts and a check that they decode to the same bytes."""
    ship_package(spark)
    return byte_bpe.digest(docs, *vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the result of each is staged and read again."""
    stages = Stages(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        staged = stages.save(stage(spark, docs, sf_dir), name)
        if hasattr(docs, "staged_path"):
            stages.drop(docs)
        docs = staged
    return docs
