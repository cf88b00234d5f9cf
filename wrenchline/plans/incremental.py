"""Runs over new packages only: files are listed by a stream that remembers what it has seen."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession

from wrenchline.config import DEFAULT_CONFIG, EngineConfig
from wrenchline.plans.batch import BatchPaths, run_batch

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _literal(path: str) -> str:
    """The path as one that holds no pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def run_new_packages(
    spark: SparkSession,
    paths: BatchPaths,
    run_prefix: str,
    checkpoint: str,
    cfg: EngineConfig = DEFAULT_CONFIG,
    buckets: int = 16,
    file_format: str = "xlsx",
    files_per_run: int = 1000,
) -> list[str]:
    """Process the files of the input folder that no earlier call with this checkpoint has; returns the run ids.

    Every run takes at most ``files_per_run`` files, whose names alone come to the
    driver, and writes datasets of its own under ``<run_prefix>-<number>``. A run that
    is cut off is repeated under the same number and replaces what it had written, so
    every file counts once. The datasets of all runs together are those of one run
    over all files. A file that changes under its old name is not read again.
    """
    listing = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_run)
    files = listing.option("pathGlobFilter", f"*.{file_format}*").load(paths.input).select("path")
    runs = []

    def process(batch: DataFrame, number: int) -> None:
        found = sorted(_literal(row["path"]) for row in batch.collect())
        if found:
            run_id = f"{run_prefix}-{number:06d}"
            run_batch(batch.sparkSession, dataclasses.replace(paths, input=found), run_id, cfg, buckets, file_format)
            runs.append(run_id)

    stream = files.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    return runs
