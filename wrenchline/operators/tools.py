"""Tools and spares without stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig, TOOL_COLUMNS
from wrenchline.functions import ids
from wrenchline.functions.display import tool_type
from wrenchline.functions.text import is_blank, number, strip
from wrenchline.operators.lines import sheet_gate
from wrenchline.operators.quality import require_columns


def zero_stock(lines: DataFrame) -> DataFrame:
    """Named parts with no stock and no alternate; unreadable quantities are 0."""
    dtype = {f.name: f.dataType for f in lines.schema}
    quantity = lambda c: F.coalesce(number(F.col(c), dtype[c]), F.lit(0.0))
    return lines.where(
        (quantity("total_qty") == 0)
        & (quantity("alt_qty") == 0)
        & ~is_blank(F.col("tool_name"))
        & ~is_blank(F.col("part_no"))
    )


def drop_ignored(rows: DataFrame, ignore_items: DataFrame) -> DataFrame:
    """Without the rows whose part number or name is on the ignore list.

    One anti join per key: a single OR condition would be a nested loop.
    """
    normal = lambda c: F.lower(strip(F.col(c).cast("string")))
    items = ignore_items.select("item")
    return (
        rows.withColumns({"_part": normal("part_no"), "_name": normal("tool_name")})
        .join(items.withColumnRenamed("item", "_part"), "_part", "left_anti")
        .join(items.withColumnRenamed("item", "_name"), "_name", "left_anti")
        .drop("_part", "_name")
    )


def tool_issues(lines: DataFrame, ignore_items: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Report rows; every line counts, repeated or not, whatever its sequence."""
    require_columns(lines, TOOL_COLUMNS, "tool control")
    source = sheet_gate(lines, cfg, "tool") if cfg.filter_tools_by_rule else lines
    if "has_tool_columns" in lines.columns:  # exports that lack one are not checked
        source = source.where("has_tool_columns")
    found = drop_ignored(zero_stock(source), ignore_items)
    extra = [F.col("percentage")] if "percentage" in lines.columns else []
    return found.select(
        "workpack_id",
        "row_no",
        "seq",
        ids.task_id(cfg, F.col("seq"), F.col("title")).alias("task_id"),
        "part_no",
        "tool_name",
        tool_type(F.col("tool_flag")).alias("type"),
        *extra,
        is_blank(F.col("seq")).alias("seq_missing"),
    )


def tool_summary(issues: DataFrame) -> DataFrame:
    kind = F.col("type")
    return issues.groupBy("workpack_id").agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(kind == "Tool").alias("total_tools"),
        F.count_if(kind == "Spare").alias("total_spares"),
        F.count_distinct("part_no").alias("unique_parts"),
        F.count_distinct("seq").alias("affected_seqs"),
    )


def tool_counts_by_type(issues: DataFrame) -> DataFrame:
    """Tool, spare and unknown counts; other types are not reported."""
    kind = F.col("type")
    return issues.groupBy("workpack_id").agg(
        F.count_if(kind == "Tool").alias("tools"),
        F.count_if(kind == "Spare").alias("spares"),
        F.count_if(kind == "Unknown").alias("unknown"),
    )
