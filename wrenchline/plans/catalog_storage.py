"""Named queries that go through storage or take their rules from tables.

Folders are made below the shared folder of the cluster, written by Spark and read
back by the sources that a job uses.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.config import DEFAULT_CONFIG as CFG
from wrenchline.config import REQUIRED_COLUMNS, TOOL_COLUMNS
from wrenchline.functions.hours import decimal_sum, hours_sum, rounded
from wrenchline.operators import lines as line_ops
from wrenchline.operators import metrics, quality, site_rules, tools
from wrenchline.plans.report import Lookups, build_reports
from wrenchline.shipping import ship_package
from wrenchline.sources import exports, file_columns, lookups, reports, text_records
from wrenchline.sources import star_tables as star
from wrenchline.storage import new_folder, staged, staged_once

_NAMES = {logical: export for export, logical in CFG.columns.items()}
_EXPORTED = ("seq", "title", "planned_min")
BUCKETS = 8


def _exported(rows: DataFrame, *logical: str) -> DataFrame:
    """Lines as an export names them, with the folder they go to in ``workpack``."""
    return rows.select("workpack", *[F.col(c).alias(_NAMES[c]) for c in logical])


def _write(rows: DataFrame, path: str, file_format: str) -> None:
    writer = rows.write.mode("append").partitionBy("workpack")
    (writer.option("header", True) if file_format == "csv" else writer).format(file_format).save(path)


def q46_file_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns, types and rows that two shapes of the line table have on storage, and what each lacks."""
    ship_package(spark)
    path = new_folder(spark, "shapes")
    rows = star.lines(spark, folder, "seq", "planned_min", "part_no", "start_date")
    odd = F.col("row_no.l_linenumber") % 2 == 1
    plain = rows.where(odd).withColumn("workpack", F.lit("plain"))
    full = rows.where(~odd).withColumns({"workpack": F.lit("full"), "planned_min": F.col("planned_min").try_cast("double"), "title": F.lit("t")})
    _write(_exported(plain, "seq", "part_no", "start_date"), path, "parquet")
    _write(_exported(full, "seq", "title", "planned_min"), path, "parquet")
    files = staged(file_columns.file_columns(spark, path, "parquet", per="folder"), f"{path}-files")
    lacking = F.array_join(file_columns.missing_columns([_NAMES[c] for c in REQUIRED_COLUMNS]), ", ")
    table = file_columns.column_table(files).groupBy("workpack_id", F.col("name").alias("column_name"), F.col("type").alias("column_type"))
    shapes = files.groupBy("workpack_id").agg(F.max(lacking).alias("missing"), F.bool_and(file_columns.has_column(_NAMES["title"])).alias("has_title"))
    return table.agg(F.sum("rows").alias("lines")).join(shapes, "workpack_id").withColumnRenamed("workpack_id", "shape")


def q47_isolated_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Eight packages as csv, json and parquet; one lacks a required column, one has others in another order."""
    ship_package(spark)
    number = F.col("workpack_id") % 8
    lines = star.lines(spark, folder, *_EXPORTED).withColumn("workpack", F.concat(F.lit("P"), number.cast("string")))
    lines = lines.withColumn("event", F.col("row_no.l_partkey").cast("string"))
    path = new_folder(spark, "exports")
    # The lines are joined once and not for each file that is written.
    lines = staged(lines.select("workpack_id", "workpack", "event", *_EXPORTED), f"{path}/lines")
    results = []
    for file_format in ("csv", "json", "parquet"):
        own = f"{path}/{file_format}"
        _write(_exported(lines.where(~number.isin(5, 6)), *_EXPORTED), own, file_format)
        _write(_exported(lines.where(number == 5), "title", "seq"), own, file_format)
        _write(_exported(lines.where(number == 6), "event", "planned_min", "title", "seq"), own, file_format)
        store = lambda df, name, at=path, kind=file_format: staged(df, f"{at}/{kind}-{name}")
        found = exports.read_folder(spark, own, file_format, CFG, store, per="folder")
        hours = line_ops.with_base_hours(found.lines).groupBy("workpack_id").agg(
            hours_sum(F.col("base_hours")).alias("base_hours"),
            F.count("seq").alias("with_seq"),
            F.count("title").alias("with_title"),
            F.count("event").alias("with_event"),
            F.bool_or("has_event").alias("has_event"),
        )
        results.append(found.status.join(hours, "workpack_id", "left").withColumn("format", F.lit(file_format)))
    columns = ("format", "workpack_id", "status", "rows", "error", "base_hours", "with_seq", "with_title", "with_event", "has_event")
    return reduce(lambda a, b: a.unionByName(b), results).select(*columns)


def q48_sink_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Hours per package written by buckets, some packages replaced in place, and all read back with the manifest."""
    lines = line_ops.with_base_hours(star.lines(spark, folder, "planned_min"))
    sums = lines.groupBy("workpack_id").agg(F.count("*").alias("lines"), decimal_sum(F.col("base_hours")).alias("hours"))
    sums = sums.select("workpack_id", "lines", rounded(F.col("hours")).alias("hours"), F.lit(1).alias("version"))
    path = reports.write_report(sums, new_folder(spark, "sink"), "hours", "first", BUCKETS)
    written = spark.read.parquet(path).drop(reports.BUCKET)
    again = written.where("workpack_id % 5 = 2").select("workpack_id", "lines", (F.col("hours") * 2).alias("hours"), F.lit(2).alias("version"))
    reports.replace_packages(again, path, BUCKETS)
    told = reports.manifest(spark, path).agg(F.sum("rows").alias("manifest_rows"), F.sum("packages").alias("manifest_packages")).first()
    totals = [F.lit(n).cast("bigint").alias(name) for name, n in told.asDict().items()]
    return spark.read.parquet(path).select("workpack_id", "lines", "hours", "version", *totals)


def q49_text_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of four lines from whole texts, the first of every question; a cut record counts as incomplete."""
    found = text_records.records_of_texts(star.read(spark, folder, "documents"), "doc_id", "text")
    kept = text_records.keep_first_records(found, "doc_id")
    return kept.select(
        "doc_id",
        "record_no",
        F.md5(F.col("question")).alias("question_md5"),
        F.size("answers").alias("n_answers"),
        F.md5(F.array_join("answers", "\n")).alias("answers_md5"),
        "complete",
    )


def q50_hours_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Delivered hours beside recomputed ones, where some lines were changed, left out or made up on delivery."""
    expected = line_ops.with_base_hours(star.lines(spark, folder, "planned_min")).select("workpack_id", "row_no", "base_hours")
    supplier, number = F.col("row_no.l_suppkey"), F.col("row_no.l_linenumber")
    changed = F.when(supplier % 13 == 3, F.col("base_hours") + 0.5).when(supplier % 13 == 4, F.col("base_hours") + 0.005)
    delivered = expected.where((F.col("row_no.l_partkey") % 17 != 0)).withColumn("base_hours", F.coalesce(changed, F.col("base_hours")))
    made_up = expected.where((supplier % 29 == 1) & (number == 1)).withColumn("row_no", F.col("row_no").withField("l_linenumber", F.lit(100).cast("int")))
    kind = expected.schema["row_no"].dataType
    delivered = delivered.unionByName(made_up.withColumn("row_no", F.col("row_no").cast(kind)))
    delivered = staged(delivered, new_folder(spark, "delivered"))
    return quality.reconciliation_summary(quality.reconcile(delivered, expected, ["workpack_id", "row_no"], "base_hours"), "base_hours")


def _sited(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rules = site_rules.rule_rows(spark, CFG).unionByName(star.site_rules(spark, folder))
    return star.lines(spark, folder, "seq").join(star.sites(spark, folder), "workpack_id", "left"), rules


def q51_site_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What the rules of its site say of every line."""
    lines, rules = _sited(spark, folder)
    found = site_rules.with_site_rules(lines, rules, CFG)
    modes = ("base_mode", "mhr_mode", "newtask_mode", "tool_mode")
    return found.select("workpack_id", *star.row_columns(), "site", *modes, "id_method", "coefficient", "level", "processed", "check_ref")


def q52_site_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hours per site by its own rules, lines that are kept unchecked apart."""
    _, rules = _sited(spark, folder)
    lines = star.lines(spark, folder, "seq", "planned_min").join(star.sites(spark, folder), "workpack_id", "left")
    rows = line_ops.with_base_hours(site_rules.with_site_rules(lines, rules, CFG)).where("processed")
    counted = F.col("seq").isNotNull() & (F.col("mhr_mode") != "ignore")
    return rows.groupBy("site").agg(
        F.count("*").alias("lines"),
        F.count_if(~F.col("check_ref")).alias("unchecked"),
        hours_sum(F.when(counted, F.col("base_hours"))).alias("base_hours"),
        hours_sum(F.when(counted, F.col("base_hours") * F.col("coefficient"))).alias("adjusted_hours"),
    )


def q53_site_rule_findings(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of all sites that look wrong, where the general rules have lost one prefix."""
    general = site_rules.rule_rows(spark, CFG).where("prefix <> '4'")
    return site_rules.site_findings(general.unionByName(star.site_rules(spark, folder)))


def q54_union_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Three sheets whose columns differ in names and types as one table."""
    part = star.read(spark, folder, "part")
    number = F.col("p_partkey")
    return lookups.union_sheets(
        {
            "whole": part.select(number.alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("amount")),
            "priced": part.where(number % 3 == 0).select(F.col("p_brand").alias("brand"), (F.col("p_size") / F.lit(4.0)).alias("amount")),
            "coded": part.where(number % 5 == 0).select(F.concat(F.lit("K"), number.cast("string")).alias("key"), F.col("p_type").alias("name")),
        }
    )


def q55_ignore_file(spark: SparkSession, folder: str) -> DataFrame:
    """The ignore list from a text file with comments, blanks, capitals and repeats."""
    part = star.read(spark, folder, "part")
    key = F.col("p_partkey")
    line = (
        F.when(key % 6 == 0, F.concat(F.lit("# "), F.col("p_name")))
        .when(key % 6 == 1, "   ")
        .when(key % 6 == 2, F.concat(F.lit("\t#"), F.col("p_type")))
        .when(key % 6 == 3, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" \t")))
        .when(key % 6 == 4, F.concat(F.lit("STD-"), (key % 100).cast("string")))
        .otherwise(F.lower("p_name"))
    )
    path = new_folder(spark, "ignore-list")
    part.select(line.alias("value")).write.text(path)
    return lookups.ignore_items(spark, path)


def q56_tool_percentages(spark: SparkSession, folder: str) -> DataFrame:
    """Tool report with the optional percentage column."""
    columns = ("seq", "title", "tool_name", "part_no", "tool_flag", "total_qty", "alt_qty", "percentage")
    issues = tools.tool_issues(star.lines(spark, folder, *columns), star.ignore_items(spark, folder), CFG)
    return issues.select("workpack_id", *star.row_columns(), "part_no", "type", "percentage")


def q57_group_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and hours of every stage and package from one reading of the lines."""
    rows = star.lines(spark, folder, "seq", "planned_min")
    groups = line_ops.kept_groups(rows, CFG, lambda kept: star.with_part(kept, spark, folder, "title"))
    return metrics.group_metrics(groups, CFG)


def q58_report_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every dataset that a run builds, with all switches on and with special codes and tools off."""
    columns = ("seq", "title", "planned_min", "wpno", "start_date", "end_date", "special_code", "func_group", *TOOL_COLUMNS)
    path = new_folder(spark, "reports")
    lines = staged(star.lines(spark, folder, *columns), f"{path}/lines")
    tables = Lookups(
        registrations=star.registrations(spark, folder),
        bonus_rows=star.bonus_rows(spark, folder),
        reference=star.reference(spark, folder),
        ignore_items=star.ignore_items(spark, folder),
        type_coefficient_rows=star.type_coefficient_rows(spark, folder),
    )
    plain = dataclasses.replace(CFG, enable_special_code=False, enable_tool_control=False)
    counts, store = [], staged_once(path)
    for switches, cfg in (("on", CFG), ("off", plain)):
        datasets = build_reports(lines, tables, cfg, store)
        counts += [df.select(F.lit(switches).alias("switches"), F.lit(name).alias("dataset")) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b), counts).groupBy("switches", "dataset").agg(F.count("*").alias("rows"))


QUERIES = {
    f.__name__: f
    for f in (
        q46_file_columns, q47_isolated_exports, q48_sink_round_trip, q49_text_records, q50_hours_reconciliation,
        q51_site_rules, q52_site_hours, q53_site_rule_findings, q54_union_sheets, q55_ignore_file, q56_tool_percentages,
        q57_group_metrics, q58_report_datasets,
    )
}
