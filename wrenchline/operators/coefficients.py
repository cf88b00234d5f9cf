"""Summaries of applied coefficients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions.hours import hours_sum


def coefficient_summary(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Per package and coefficient: rows, rows with a sequence, hours.

    ``is_skip_value`` marks the coefficient that skipped tasks get.
    """
    return (
        rows.groupBy("workpack_id", "coefficient")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("seq").alias("count"),
            hours_sum(F.col("base_hours")).alias("base_hours"),
            hours_sum(F.col("adjusted_hours")).alias("adjusted_hours"),
        )
        .withColumn("is_skip_value", F.col("coefficient") == F.lit(float(cfg.skip_coefficient)))
    )
