"""Line-level steps: hours, task IDs, gates, keep-first, coefficients."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions import ids
from wrenchline.functions.hours import decimal_sum, minutes_to_hours
from wrenchline.operators.keep_first import keep_first


def dedup_key(lines: DataFrame) -> Column:
    """Lines repeat per ``event`` where the export has it, else per sequence.

    ``has_event`` tells it per line when packages with and without it are mixed.
    """
    if "event" not in lines.columns:
        return F.col("seq")
    if "has_event" not in lines.columns:
        return F.col("event")
    # The flag keeps an event and an equal sequence of another export apart.
    key = F.when(F.col("has_event"), F.col("event").cast("string")).otherwise(F.col("seq").cast("string"))
    return F.struct(F.col("has_event").alias("event"), key.alias("key"))


def with_base_hours(lines: DataFrame) -> DataFrame:
    dtype = lines.schema["planned_min"].dataType
    return lines.withColumn("base_hours", minutes_to_hours(F.col("planned_min"), dtype))


def with_task_id(lines: DataFrame, cfg: EngineConfig, sheet: str = "base") -> DataFrame:
    """Task ID, and whether it is to be checked against the reference lists."""
    seq = F.col("seq")
    return lines.withColumns(
        {
            "task_id": ids.task_id(cfg, seq, F.col("title")),
            "check_ref": ids.should_check_reference(cfg, seq, sheet),
        }
    )


def with_coefficient(lines: DataFrame, cfg: EngineConfig, use_skip_codes: bool = True) -> DataFrame:
    """Coefficient by prefix and adjusted hours; skip codes in the task ID win."""
    task = F.col("task_id") if use_skip_codes else None
    with_coef = lines.withColumn("coefficient", ids.seq_coefficient(cfg, F.col("seq"), task))
    return with_coef.withColumn("adjusted_hours", F.col("base_hours") * F.col("coefficient"))


def base_gate(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Lines whose prefix is not ignored; a null sequence passes."""
    kept = lines.where(ids.should_process(cfg, F.col("seq")))
    return with_task_id(kept, cfg)


def in_sheet(cfg: EngineConfig, sheet: str) -> Column:
    """Gate of one output; a null sequence is out."""
    seq = F.col("seq")
    return seq.isNotNull() & ids.should_process(cfg, seq, sheet)


def sheet_gate(lines: DataFrame, cfg: EngineConfig, sheet: str) -> DataFrame:
    return lines.where(in_sheet(cfg, sheet))


def _with_values(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Task ID, hours and coefficient, as far as their columns are there."""
    rows = lines
    if "title" in lines.columns:
        rows = with_task_id(rows, cfg)
    if "planned_min" in lines.columns:
        rows = with_base_hours(rows)
        if "title" in lines.columns:
            rows = with_coefficient(rows, cfg)
    return rows


#: Adds columns to the rows that keep-first leaves, e.g. by a join that all lines need not go through.
Enrich = Callable[[DataFrame], DataFrame]


def kept_lines(lines: DataFrame, cfg: EngineConfig, enrich: Enrich = lambda rows: rows) -> DataFrame:
    """First line per key where the base gate lets it pass, and the first of all others.

    The lines the gate drops are not filtered but reduced to one per package
    (``processed`` is false there), so every package keeps its first line.
    Package headers, empty packages and hour sums then come from one pass and
    one line shuffle. Values are worked out for the kept lines only.
    """
    rows = lines.withColumn("processed", ids.should_process(cfg, F.col("seq")))
    key = F.when(F.col("processed"), dedup_key(lines))
    return _with_values(enrich(keep_first(rows, ["workpack_id", "processed", key])), cfg)


def kept_groups(lines: DataFrame, cfg: EngineConfig, enrich: Enrich = lambda rows: rows) -> DataFrame:
    """``kept_lines`` with what each of them stands for: ``group_rows`` and ``group_hours`` of the lines of its key.

    One aggregation instead of a window, so that numbers about all lines need no
    second reading. It sums in every task before the shuffle, as the window cuts there.
    """
    if "planned_min" not in lines.columns:
        raise ValueError("groups need planned_min")
    rows = with_base_hours(lines.withColumn("processed", ids.should_process(cfg, F.col("seq"))))
    rows = rows.withColumn("_key", F.when(F.col("processed"), dedup_key(lines)))
    carried = [c for c in lines.columns if c not in ("workpack_id", "row_no")]
    # The smallest struct and not min_by: that would send row_no twice.
    first = F.min(F.struct("row_no", *carried)).alias("_first")
    groups = rows.groupBy("workpack_id", "processed", "_key").agg(
        first, F.count(F.lit(1)).alias("group_rows"), decimal_sum(F.col("base_hours")).alias("group_hours")
    )
    kept = groups.select("workpack_id", "_first.*", "processed", "group_rows", "group_hours")
    return _with_values(enrich(kept), cfg)


def base_rows(lines: DataFrame, cfg: EngineConfig, enrich: Enrich = lambda rows: rows) -> DataFrame:
    """Base gate, then keep-first; the gate is applied where the lines are read."""
    rows = lines.where(ids.should_process(cfg, F.col("seq")))
    return _with_values(enrich(keep_first(rows, ["workpack_id", dedup_key(lines)])), cfg)


def mhr_rows(lines: DataFrame, cfg: EngineConfig, enrich: Enrich = lambda rows: rows) -> DataFrame:
    """Lines that count for the hour totals."""
    return base_rows(lines, cfg, lambda rows: enrich(sheet_gate(rows, cfg, "mhr")))


def high_hour_tasks(mhr: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Tasks strictly above the threshold, before coefficients unless set otherwise."""
    return mhr.where(F.col(cfg.high_hours_basis) > cfg.high_hours)
