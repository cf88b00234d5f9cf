"""Named queries over the order / line / part tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.functions import display, hours, ids
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
    text_dedup,
    tools,
    type_coefficients,
)
from wrenchline.plans.catalog_storage import QUERIES as STORAGE_QUERIES
from wrenchline.sources import rules, star_tables as star

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

_MHR = ("seq", "planned_min")
_HEADER = ("wpno", "start_date", "end_date")


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return {**_QUERIES, **STORAGE_QUERIES}


def _part(spark: SparkSession, folder: str, *columns: str) -> line_ops.Enrich:
    return lambda rows: star.with_part(rows, spark, folder, *columns)


def _mhr(spark: SparkSession, folder: str) -> DataFrame:
    return line_ops.mhr_rows(star.lines(spark, folder, *_MHR), CFG, _part(spark, folder, "title"))


def _kept(spark: SparkSession, folder: str, *extra: str, part: tuple[str, ...] = ("title",)) -> DataFrame:
    rows = star.lines(spark, folder, *_MHR, *_HEADER, *extra)
    return line_ops.kept_lines(rows, CFG, _part(spark, folder, *part))


def _registrations(spark: SparkSession, folder: str) -> DataFrame:
    return packages.registration_table(star.registrations(spark, folder))


def _bonus(spark: SparkSession, folder: str) -> DataFrame:
    return bonus.bonus_table(star.bonus_rows(spark, folder))


def _packages(spark: SparkSession, folder: str) -> DataFrame:
    headers = packages.package_headers(star.lines(spark, folder, *_HEADER), CFG)
    return packages.with_aircraft_type(headers, _registrations(spark, folder))


def _type_table(spark: SparkSession, folder: str) -> DataFrame:
    return type_coefficients.type_coefficient_table(star.type_coefficient_rows(spark, folder))


def _tool_issues(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("seq", "title", "tool_name", "part_no", "tool_flag", "total_qty", "alt_qty")
    return tools.tool_issues(
        star.lines(spark, folder, *columns), star.ignore_items(spark, folder), CFG
    )


def _new_ids(spark: SparkSession, folder: str) -> DataFrame:
    return new_tasks.new_task_ids(
        star.lines(spark, folder, "seq", "title"), star.reference(spark, folder), CFG
    )


def _line(df: DataFrame, *columns) -> DataFrame:
    return df.select("workpack_id", *star.row_columns(), *columns)


@query
def q01_rules(spark, folder):
    """Resolved rules with the lines they govern; prefixes without a rule show defaults."""
    prefixes = star.lines(spark, folder, "seq").groupBy(ids.seq_prefix(F.col("seq")).alias("prefix"))
    return rules.rules_with_usage(spark, prefixes.agg(F.count(F.lit(1)).alias("lines")), CFG)


@query
def q02_base_gate(spark, folder):
    rows = line_ops.base_gate(star.lines(spark, folder, "seq", "title"), CFG)
    return _line(rows, "task_id", "check_ref")


@query
def q03_base_hours(spark, folder):
    return _line(line_ops.with_base_hours(star.lines(spark, folder, "planned_min")), "base_hours")


@query
def q04_keep_first(spark, folder):
    return _line(line_ops.base_rows(star.lines(spark, folder, "seq"), CFG), "seq")


@query
def q05_mhr_rows(spark, folder):
    return _line(line_ops.mhr_rows(star.lines(spark, folder, "seq"), CFG), "seq")


@query
def q06_seq_coefficient(spark, folder):
    return _line(_mhr(spark, folder), "seq", "coefficient", "adjusted_hours")


@query
def q07_high_hours(spark, folder):
    high = line_ops.high_hour_tasks(_mhr(spark, folder), CFG)
    return high.select(
        "workpack_id",
        "seq",
        "title",
        "task_id",
        hours.hours_to_hhmm(F.col("base_hours")).alias("base_mhrs"),
        is_blank(F.col("seq")).alias("seq_missing"),
    )


@query
def q08_package_header(spark, folder):
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return _packages(spark, folder).select(
        "workpack_id", "ac_name", "wp_type", "ac_type", "check_group", day("start_date"), day("end_date"), "days"
    )


@query
def q09_bonus_table(spark, folder):
    return _bonus(spark, folder)


@query
def q10_package_bonus(spark, folder):
    found = packages.with_bonus(_packages(spark, folder), _bonus(spark, folder))
    return found.select("workpack_id", "bonus_hours")


@query
def q11_bonus_breakdown(spark, folder):
    return bonus.bonus_breakdown(_packages(spark, folder), star.bonus_rows(spark, folder))


@query
def q12_totals(spark, folder):
    totals = packages.package_totals(
        _kept(spark, folder),
        _registrations(spark, folder),
        _bonus(spark, folder),
        CFG,
    )
    return totals.select(
        "workpack_id",
        "base_hours",
        "coefficient_effect",
        "adjusted_hours",
        "bonus_hours",
        "total_hours",
        "base_hhmm",
        "total_hhmm",
    )


def _special(spark: SparkSession, folder: str) -> DataFrame:
    return special_codes.special_code_hours(_kept(spark, folder, "special_code"), CFG)


@query
def q13_special_codes(spark, folder):
    return _special(spark, folder).select("workpack_id", "special_code", "hours", "hours_per_day", "rank")


@query
def q14_special_table(spark, folder):
    return special_codes.special_code_table(
        _kept(spark, folder, "special_code"),
        _registrations(spark, folder),
        _bonus(spark, folder),
        CFG,
    )


@query
def q15_special_summary(spark, folder):
    return special_codes.special_code_summary(_special(spark, folder))


@query
def q16_new_task_ids(spark, folder):
    found = new_tasks.new_task_report(_new_ids(spark, folder))
    return found.select(
        "workpack_id", "seq", "new_task_id", "description", "is_eo", "source_rank", "seq_missing"
    )


@query
def q17_new_id_summary(spark, folder):
    return new_tasks.new_task_summary(_new_ids(spark, folder))


@query
def q18_tool_issues(spark, folder):
    return _line(
        _tool_issues(spark, folder), "seq", "task_id", "part_no", "tool_name", "type", "seq_missing"
    )


@query
def q19_tool_summary(spark, folder):
    return tools.tool_summary(_tool_issues(spark, folder))


@query
def q20_coefficient_summary(spark, folder):
    return coefficients.coefficient_summary(_mhr(spark, folder), CFG)


@query
def q21_type_coeff_table(spark, folder):
    return type_coefficients.table_statistics(_type_table(spark, folder))


def _with_types(operator, spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = star.lines(spark, folder, *columns, "func_group")
    return operator(rows, _packages(spark, folder), _type_table(spark, folder), CFG)


@query
def q22_type_coeff_lines(spark, folder):
    rows = _with_types(type_coefficients.type_coefficient_lines, spark, folder, "seq", "planned_min")
    return _line(rows, "type_coefficient", "adjusted_hours")


@query
def q23_type_coeff_breakdown(spark, folder):
    return _with_types(type_coefficients.type_coefficient_breakdown, spark, folder, "seq", "planned_min")


@query
def q24_function_map(spark, folder):
    found = _with_types(type_coefficients.function_map, spark, folder, "seq", "planned_min")
    return found.select("workpack_id", "func_group", "type_coefficient")


@query
def q25_text_keep_first(spark, folder):
    return text_dedup.keep_first_text(star.read(spark, folder, "documents"), "text", "doc_id")


@query
def q26_sample(spark, folder):
    identity = F.concat_ws("-", *[F.col(f"row_no.{c}") for c in star.ROW_ORDER])
    rows = _mhr(spark, folder)
    return _line(sampling.sample_per_package(rows, identity, CFG.sample_size, CFG.sample_seed), "seq")


@query
def q27_non_numeric(spark, folder):
    return _line(quality.non_numeric_rows(star.lines(spark, folder, "planned_min"), "planned_min"))


@query
def q28_empty_share(spark, folder):
    columns = ("seq", "title", "special_code", "part_no", "tool_flag", "alt_qty")
    return quality.empty_shares(star.lines(spark, folder, *columns), columns, 0.3)


@query
def q29_bad_seq(spark, folder):
    return _line(quality.bad_sequences(star.lines(spark, folder, "seq")), "seq")


@query
def q30_bad_dates(spark, folder):
    headers = packages.package_headers(star.lines(spark, folder, *_HEADER), CFG)
    return quality.reversed_dates(headers).select("workpack_id")


@query
def q31_coefficient_check(spark, folder):
    return quality.coefficient_mismatches(_mhr(spark, folder))


@query
def q32_duplicate_seq(spark, folder):
    return quality.duplicate_sequences(star.lines(spark, folder, "seq"))


@query
def q33_registration(spark, folder):
    return _registrations(spark, folder)


@query
def q34_reference_ids(spark, folder):
    return star.reference(spark, folder)


@query
def q35_ignore_list(spark, folder):
    return star.ignore_items(spark, folder)


@query
def q36_display(spark, folder):
    rows = line_ops.with_task_id(star.lines(spark, folder, "seq", "title", "special_code", "tool_flag"), CFG)
    return _line(
        rows,
        display.clean(F.col("title")).alias("title"),
        display.truncate(F.col("title"), 12).alias("short_title"),
        display.seq_display(F.col("seq")).alias("seq"),
        display.task_id_display(F.col("task_id")).alias("task_id"),
        display.special_code_display(F.col("special_code")).alias("special_code"),
        display.tool_type(F.col("tool_flag")).alias("type"),
    )


@query
def q37_run_metrics(spark, folder):
    rows = star.lines(spark, folder, *_MHR)
    return metrics.run_metrics(rows, line_ops.kept_lines(rows, CFG, _part(spark, folder, "title")), CFG)


@query
def q38_type_coeff_totals(spark, folder):
    return _with_types(type_coefficients.type_coefficient_totals, spark, folder, "seq", "planned_min")


@query
def q39_tool_counts(spark, folder):
    return tools.tool_counts_by_type(_tool_issues(spark, folder))


@query
def q40_special_code_usable(spark, folder):
    return special_codes.usable_special_codes(star.lines(spark, folder, "special_code"))


@query
def q41_sheet_gates(spark, folder):
    """Lines each output lets through, before any keep-first."""
    rows = star.lines(spark, folder, "seq")
    seq = F.col("seq")
    return rows.groupBy("workpack_id").agg(
        F.count_if(ids.should_process(CFG, seq)).alias("base"),
        F.count_if(line_ops.in_sheet(CFG, "mhr")).alias("mhr"),
        F.count_if(ids.should_process(CFG, seq, "newtask")).alias("newtask"),
        F.count_if(line_ops.in_sheet(CFG, "tool")).alias("tool"),
        F.count_if(ids.should_check_reference(CFG, seq)).alias("checked"),
    )


@query
def q42_display_hours(spark, folder):
    """Hours as a clock text, read back as a time cell, and as a share of a day."""
    rows = line_ops.with_base_hours(star.lines(spark, folder, "planned_min"))
    rows = rows.withColumn("clock", F.concat(hours.hours_to_hhmm(F.col("base_hours")), F.lit(":30")))
    return _line(
        rows,
        "clock",
        hours.time_to_hours(F.col("clock")).alias("clock_hours"),
        display.format_percentage(F.col("base_hours") / 24).alias("day_share"),
    )


@query
def q43_first_functions(spark, folder):
    """Distinct functions of a package with the line they first occur in."""
    rows = star.lines(spark, folder, "seq", "planned_min", "func_group")
    seen = type_coefficients.first_seen_functions(rows, CFG).withColumnRenamed("first_row", "row_no")
    return _line(seen, "func_group")


@query
def q44_plain_coefficient(spark, folder):
    """Coefficients by sequence alone, on all lines and without skip codes."""
    rows = line_ops.with_base_hours(star.lines(spark, folder, "seq", "planned_min"))
    return _line(line_ops.with_coefficient(rows, CFG, use_skip_codes=False), "coefficient", "adjusted_hours")


@query
def q45_totals_by_type(spark, folder):
    """Package totals with type coefficients in place of the sequence ones."""
    kept = type_coefficients.with_type_hours(
        _kept(spark, folder, part=("title", "func_group")), _packages(spark, folder), _type_table(spark, folder), CFG
    )
    totals = packages.package_totals(kept, _registrations(spark, folder), _bonus(spark, folder), CFG)
    return totals.select("workpack_id", "base_hours", "adjusted_hours", "bonus_hours", "total_hours")
