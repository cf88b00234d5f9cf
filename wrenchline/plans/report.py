"""All report datasets of a set of work packages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.config import REQUIRED_COLUMNS, TOOL_COLUMNS, EngineConfig
from wrenchline.functions.hours import hours_to_hhmm
from wrenchline.functions.text import is_blank
from wrenchline.operators import (
    bonus,
    coefficients,
    lines as line_ops,
    metrics,
    new_tasks,
    packages,
    quality,
    sampling,
    special_codes,
    tools,
    type_coefficients,
)


@dataclass(frozen=True)
class Lookups:
    """Reference tables, as the sources deliver them."""

    registrations: DataFrame
    bonus_rows: DataFrame
    reference: DataFrame
    ignore_items: DataFrame
    type_coefficient_rows: DataFrame | None = None


def build_reports(
    lines: DataFrame,
    lookups: Lookups,
    cfg: EngineConfig,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    all_packages: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """{dataset: DataFrame}, each keyed by ``workpack_id``.

    Most datasets start from the kept lines, the others from the line table or
    the package headers. ``stage`` can store those two under a name and return
    the stored table, so that the large shuffles run once for all datasets; by
    default nothing is stored and nothing runs yet. ``all_packages`` (workpack_id)
    names packages that have a total even without lines.
    """
    quality.require_columns(lines, REQUIRED_COLUMNS, "line table")
    registrations = packages.registration_table(lookups.registrations)
    bonus_hours = bonus.bonus_table(lookups.bonus_rows)
    # The kept lines hold the first line of every package, so headers need no other scan.
    kept = stage(line_ops.kept_groups(lines, cfg), "kept_lines")
    headers = packages.with_aircraft_type(packages.package_headers(kept, cfg), registrations)
    headers = stage(headers, "headers")

    by_type = cfg.coefficient_system == "type" and lookups.type_coefficient_rows is not None
    if lookups.type_coefficient_rows is not None:
        table = type_coefficients.type_coefficient_table(lookups.type_coefficient_rows)
    if by_type:
        kept = stage(type_coefficients.with_type_hours(kept, headers, table, cfg), "typed_lines")
    mhr = line_ops.sheet_gate(kept.where("processed").drop("processed", "group_rows", "group_hours"), cfg, "mhr")

    high = line_ops.high_hour_tasks(mhr, cfg).select(
        "workpack_id",
        "row_no",
        "seq",
        "title",
        "task_id",
        hours_to_hhmm(F.col("base_hours")).alias("base_mhrs"),
        is_blank(F.col("seq")).alias("seq_missing"),
    )
    found = new_tasks.new_task_ids(lines, lookups.reference, cfg)
    identity = F.col("row_no").cast("string")
    reports = {
        "totals": packages.package_totals(kept, registrations, bonus_hours, cfg, all_packages),
        "high_tasks": high,
        "new_task_ids": new_tasks.new_task_report(found),
        "new_id_summary": new_tasks.new_task_summary(found),
        "oversized_hours": quality.oversized_hours(lines),
        "bonus_breakdown": bonus.bonus_breakdown(headers, lookups.bonus_rows),
        "coefficient_summary": coefficients.coefficient_summary(mhr, cfg),
        "run_metrics": metrics.group_metrics(kept, cfg),
        "sample": sampling.sample_per_package(mhr, identity, cfg.sample_size, cfg.sample_seed),
    }
    if cfg.enable_special_code and "special_code" in lines.columns:
        reports["special_codes"] = special_codes.special_code_table(kept, registrations, bonus_hours, cfg)
    if cfg.enable_tool_control and not quality.missing_columns(lines, TOOL_COLUMNS):
        reports["tool_issues"] = tools.tool_issues(lines, lookups.ignore_items, cfg)
        reports["tool_summary"] = tools.tool_summary(reports["tool_issues"])
        reports["tool_counts"] = tools.tool_counts_by_type(reports["tool_issues"])
    if lookups.type_coefficient_rows is not None and "func_group" in lines.columns:
        counted = mhr if cfg.type_coefficient_per_seq else None
        reports["type_coefficients"] = type_coefficients.type_coefficient_breakdown(lines, headers, table, cfg, counted)
        reports["type_coefficient_totals"] = type_coefficients.type_coefficient_totals(lines, headers, table, cfg, counted)
    return reports
