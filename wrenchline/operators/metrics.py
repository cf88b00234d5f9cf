"""Numbers of a run: rows and hours after each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions.hours import decimal_sum, rounded
from wrenchline.operators.lines import in_sheet, with_base_hours


def group_metrics(groups: DataFrame, cfg: EngineConfig) -> DataFrame:
    """(package, stage, rows, hours) from the groups of ``lines.kept_groups``, in one aggregation.

    Stages: all lines; after base gate and keep-first; after the counted-hours gate;
    the same rows with coefficients. ``excluded_mhr`` counts what the counted-hours
    gate removed.
    """
    return _by_stage(groups.groupBy("workpack_id").agg(*_loaded_sums(), *_kept_sums(cfg)), "workpack_id")


def run_metrics(lines: DataFrame, kept: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The same from all lines and the kept lines, where those are no groups."""
    loaded = with_base_hours(lines).groupBy("workpack_id").agg(
        F.count(F.lit(1)).alias("loaded_n"), decimal_sum(F.col("base_hours")).alias("loaded_h")
    )
    # Every package keeps its first line, so none is missing on the right.
    return _by_stage(loaded.join(kept.groupBy("workpack_id").agg(*_kept_sums(cfg)), "workpack_id"), "workpack_id")


def _loaded_sums() -> list[Column]:
    return [F.sum("group_rows").alias("loaded_n"), F.sum("group_hours").alias("loaded_h")]


def _kept_sums(cfg: EngineConfig) -> list[Column]:
    base = F.col("processed")
    mhr = base & in_sheet(cfg, "mhr")
    return [
        F.count_if(base).alias("base_n"),
        decimal_sum(F.when(base, F.col("base_hours"))).alias("base_h"),
        F.count_if(mhr).alias("mhr_n"),
        decimal_sum(F.when(mhr, F.col("base_hours"))).alias("mhr_h"),
        decimal_sum(F.when(mhr, F.col("adjusted_hours"))).alias("adjusted_h"),
    ]


def _by_stage(sums: DataFrame, *keys: str) -> DataFrame:
    zero = F.lit(0.0)

    def stage(name: str, rows, hours):
        return F.struct(
            F.lit(name).alias("stage"), rows.alias("rows"), F.coalesce(rounded(hours), zero).alias("hours")
        )

    stages = (
        stage("loaded", F.col("loaded_n"), F.col("loaded_h")),
        stage("base", F.col("base_n"), F.col("base_h")),
        stage("mhr", F.col("mhr_n"), F.col("mhr_h")),
        stage("excluded_mhr", F.col("base_n") - F.col("mhr_n"), F.col("base_h") - F.coalesce("mhr_h", F.lit(0))),
        stage("coefficient", F.col("mhr_n"), F.col("adjusted_h")),
    )
    return sums.select(*keys, F.inline(F.array(*stages)))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count of a DataFrame as a by-product of the action that reads it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def observe_stages(groups: DataFrame, cfg: EngineConfig, name: str = "stages") -> tuple[DataFrame, Observation]:
    """The groups, and the numbers of the whole run as a by-product of the action that writes or reads them all."""
    observation = Observation(name)
    return groups.observe(observation, *_loaded_sums(), *_kept_sums(cfg)), observation


def stage_totals(spark: SparkSession, observation: Observation) -> DataFrame:
    """(stage, rows, hours) of a run, from what ``observe_stages`` saw; the action must have run."""
    seen = observation.get
    schema = ", ".join(f"{n} {'bigint' if n.endswith('_n') else 'decimal(38,8)'}" for n in seen)
    totals = spark.createDataFrame([tuple(seen.values())], schema)
    return _by_stage(totals.na.fill(0, [n for n in seen if n.endswith("_n")]))


def batch_result(ingest_status: DataFrame) -> DataFrame:
    """Packages that loaded and that failed."""
    return ingest_status.groupBy("status").agg(F.count(F.lit(1)).alias("packages"))
