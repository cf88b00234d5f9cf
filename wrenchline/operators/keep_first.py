"""First rows per key in line order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of each key; null keys equal each other.

    Spark limits every key to ``n`` rows before the shuffle (WindowGroupLimit),
    so a key holding a large share of the table sends ``n`` rows per task and
    not the whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: str | Column = "row_no") -> DataFrame:
    return first_n(df, keys, [order], 1)


def last_value(df: DataFrame, keys: Sequence[str], value: str, order: str = "row_no") -> DataFrame:
    """One row per key with the value of its last row."""
    last = F.max_by(F.struct(F.col(value).alias("value")), F.col(order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, F.col("_last.value").alias(value))
