"""Reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchline.operators.keep_first import first_n


def sample_per_package(rows: DataFrame, identity: Column, size: int = 10, seed: int = 1) -> DataFrame:
    """At most ``size`` rows per package, without replacement.

    Rows are ordered by a hash of the seed, the package and their ``identity``
    text, so the choice depends on the data only and repeats after a lost task.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("workpack_id").cast("string"), identity))
    drawn = rows.withColumn("_draw", draw)
    return first_n(drawn, ["workpack_id"], ["_draw", "row_no"], size).drop("_draw")
