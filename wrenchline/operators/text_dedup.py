"""Keep-first over texts and text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_fingerprint(text: Column) -> Column:
    """SHA-256 and length of the whole text: a short key for long texts."""
    return F.struct(F.sha2(text, 256).alias("sha"), F.length(text).alias("length"))


def keep_first_text(df: DataFrame, text: str, order: str) -> DataFrame:
    """First row id and copies of every distinct text.

    The shuffle carries the fingerprint and not the text, and each task sends one
    row per distinct text, so many copies of one text do not pile up.
    """
    keyed = df.select(text_fingerprint(F.col(text)).alias("_key"), F.col(order))
    return (
        keyed.groupBy("_key")
        .agg(F.min(order).alias(order), F.count(F.lit(1)).alias("copies"))
        .drop("_key")
    )
