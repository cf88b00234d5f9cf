"""Task IDs missing from the reference lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions import ids
from wrenchline.functions.text import is_blank
from wrenchline.operators.keep_first import keep_first
from wrenchline.operators.lines import dedup_key, with_task_id


def reference_ids(task_ids: DataFrame, eo_ids: DataFrame) -> DataFrame:
    """(kind, id) of both lists: nulls dropped, as text, distinct, not trimmed."""

    def listed(ids_df: DataFrame, kind: str) -> DataFrame:
        id_ = F.col(ids_df.columns[0]).cast("string")
        return ids_df.select(F.lit(kind).alias("kind"), id_.alias("id"))

    both = listed(task_ids, "task").unionByName(listed(eo_ids, "eo"))
    return both.where("id is not null").distinct()


def new_task_rows(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Keep-first over the whole table under the new-task rules.

    Independent of the counted rows; a null sequence passes this gate.
    """
    gated = lines.where(ids.should_process(cfg, F.col("seq"), "newtask"))
    return keep_first(with_task_id(gated, cfg, "newtask"), ["workpack_id", dedup_key(lines)])


def missing_ids(rows: DataFrame, reference: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Checked rows whose ID is not listed: EO rows against EO IDs, others against task IDs.

    One anti join on (kind, id) instead of one per list. ``source_rank`` puts the
    EO rows first.
    """
    is_eo = F.startswith(F.col("task_id"), F.lit(cfg.eo_prefix))
    checked = rows.where("check_ref").withColumn("is_eo", is_eo)
    keyed = checked.withColumn("kind", F.when(F.col("is_eo"), "eo").otherwise("task"))
    listed = reference.withColumnRenamed("id", "task_id")
    missing = keyed.join(listed, ["kind", "task_id"], "left_anti")
    return missing.withColumn("source_rank", F.when(F.col("is_eo"), 0).otherwise(1)).drop("kind")


def new_task_ids(lines: DataFrame, reference: DataFrame, cfg: EngineConfig) -> DataFrame:
    return missing_ids(new_task_rows(lines, cfg), reference, cfg)


def valid_ids(rows: DataFrame) -> DataFrame:
    return rows.where(ids.is_valid_task_id(F.col("task_id")))


def new_task_report(found: DataFrame) -> DataFrame:
    """Export columns of the valid new IDs; nulls as empty text."""
    empty = F.lit("")
    description = F.col("title").cast("string") if "title" in found.columns else empty
    return valid_ids(found).select(
        "workpack_id",
        "row_no",
        "source_rank",
        F.coalesce(F.col("seq").cast("string"), empty).alias("seq"),
        F.coalesce("task_id", empty).alias("new_task_id"),
        F.coalesce(description, empty).alias("description"),
        "is_eo",
        is_blank(F.col("seq")).alias("seq_missing"),
    )


def new_task_summary(found: DataFrame) -> DataFrame:
    """Valid new IDs and distinct sequences per package."""
    return valid_ids(found).groupBy("workpack_id").agg(
        F.count(F.lit(1)).alias("total_new_ids"), F.count_distinct("seq").alias("unique_seqs")
    )
