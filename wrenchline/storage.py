"""Tables between two steps, in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, fallback: str) -> str:
    """Shared folder for intermediate tables: the cluster's, or the given one."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def staged(df: DataFrame, path: str) -> DataFrame:
    """The DataFrame written once and read back, so a lost executor cannot undo it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_once(path: str) -> Callable[[DataFrame, str], DataFrame]:
    """Storing below a folder, where a table of the same plan and columns as an earlier one is not written again.

    For jobs that build their datasets several times from the same tables.
    """
    done: list[tuple[DataFrame, DataFrame]] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        for earlier, table in done:
            if df.schema == earlier.schema and df.sameSemantics(earlier):  # plans are compared without names
                return table
        done.append((df, staged(df, f"{path}/{len(done)}-{name}")))
        return done[-1][1]

    return store


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; a temporary one in local mode without that setting."""
    base = work_folder(spark, "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wrenchline-work-")
    return f"{base.rstrip('/')}/wrenchline/{name}-{uuid.uuid4().hex}"
