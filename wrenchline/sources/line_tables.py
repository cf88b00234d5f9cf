"""The line table, from workbooks or from csv, json and parquet exports.

One file is one work package; its name is the ``workpack_id``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wrenchline.config import REQUIRED_COLUMNS, TOOL_COLUMNS, EngineConfig
from wrenchline.operators.quality import require_columns
from wrenchline.sources import exports, file_columns, workbook

FORMATS = ("csv", "json", "parquet")


def _export_name(cfg: EngineConfig, logical: str) -> str:
    return next(export for export, name in cfg.columns.items() if name == logical)


def _logical_names(cfg: EngineConfig) -> list[str]:
    return list(cfg.columns.values())


def _all_of(cfg: EngineConfig, logical_names) -> Column:
    known = [n for n in logical_names if n in _logical_names(cfg)]
    flags = [workbook.has(_export_name(cfg, n)) for n in known]
    return reduce(lambda a, b: a & b, flags, F.lit(len(known) == len(logical_names)))


def lines_from_cells(cells: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Logical columns of the packages that have the required ones.

    Packages may differ in their optional columns: an absent one is null, and
    ``has_event`` and ``has_tool_columns`` tell where that changes the result.
    """
    names = _logical_names(cfg)
    rows = workbook.data_rows(cells).where(_all_of(cfg, REQUIRED_COLUMNS))
    columns = {n: workbook.text_of(_export_name(cfg, n)) for n in names}
    for date in {"start_date", "end_date"}.intersection(names):
        both = _all_of(cfg, ("start_date", "end_date"))
        columns[date] = F.when(both, columns[date])
    return rows.select(
        "workpack_id",
        "row_no",
        *[value.alias(name) for name, value in columns.items()],
        _all_of(cfg, ("event",)).alias("has_event"),
        _all_of(cfg, TOOL_COLUMNS).alias("has_tool_columns"),
    )


def ingest_status(cells: DataFrame, cfg: EngineConfig) -> DataFrame:
    """(workpack_id, status, rows, error) of every file, unreadable ones included."""
    required = [_export_name(cfg, n) for n in REQUIRED_COLUMNS]
    wanted = F.array(*[F.lit(n) for n in required])
    missing = F.array_join(F.array_except(wanted, F.col("columns")), ", ")
    problem = F.coalesce(
        F.col("error"),
        F.when(F.col("columns").isNotNull() & (missing != ""), F.concat(F.lit("Missing required columns: "), missing)),
    )
    files = cells.groupBy("workpack_id").agg(F.count_if(F.col("row_no") >= 0).alias("rows"), F.max(problem).alias("error"))
    status = F.when(F.col("error").isNull(), "ok").otherwise("failed")
    return files.select("workpack_id", status.alias("status"), "rows", "error")


def rename_exports(df: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Export names (some with dots) to logical names; other columns stay."""
    return df.withColumnsRenamed({e: n for e, n in cfg.columns.items() if e in df.columns})


def read_exports(
    spark: SparkSession, folder: str, file_format: str, cfg: EngineConfig, columns: Sequence[str] | None = None
) -> DataFrame:
    """Line table from a folder of csv, json or parquet files, all of which can be read.

    ``exports.read_folder`` takes folders whose files differ or are damaged. Here csv
    files must have the same columns; json and parquet files may differ in the
    optional ones (see ``with_presence``). ``columns`` are the export's column names;
    given them, json files are not read an extra time to find out. ``row_no`` needs
    no shuffle: parquet files number their rows, and in text formats it is the file
    split's start and the row's place in the task that reads it.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}; expected one of {FORMATS}")
    reader = spark.read.format(file_format).option("pathGlobFilter", f"*.{file_format}*")
    if file_format == "csv":
        # A file with other columns is an error, not silently shifted values.
        reader = reader.option("header", True).option("enforceSchema", False)
    elif file_format == "json":
        reader = reader.option("primitivesAsString", True)
    else:
        reader = reader.option("mergeSchema", True)
    if columns and file_format != "parquet":
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.load(folder)
    if file_format == "parquet":
        position = F.col("_metadata.row_index")
    else:
        place = F.monotonically_increasing_id()
        position = F.struct(F.col("_metadata.file_block_start").alias("split"), place.alias("place"))
    exported = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(
        workbook.file_stem(F.col("_metadata.file_path")).alias("workpack_id"), position.alias("row_no"), *exported
    )
    lines = rename_exports(rows, cfg)
    require_columns(lines, REQUIRED_COLUMNS, folder)
    if file_format == "csv":  # the table has the columns of every file
        return lines
    return with_presence(lines, file_columns.file_columns(spark, folder, file_format, list(cfg.columns)), cfg)


def with_presence(lines: DataFrame, files: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``has_event`` and ``has_tool_columns`` of each line's package, where the table has those columns.

    The files of a folder may differ: a file has events when it has the column, with
    values or not. The flags are one row per file, joined by the size that Spark finds.
    """
    wanted = {"has_event": ("event",), "has_tool_columns": TOOL_COLUMNS}
    found = {flag: names for flag, names in wanted.items() if all(n in lines.columns for n in names)}
    if not found:
        return lines
    tests = {
        flag: reduce(lambda a, b: a & b, [file_columns.has_column(_export_name(cfg, n)) for n in names])
        for flag, names in found.items()
    }
    flags = files.groupBy("workpack_id").agg(*[F.bool_or(test).alias(flag) for flag, test in tests.items()])
    return lines.join(flags, "workpack_id")


def export_status(spark: SparkSession, folder: str, file_format: str, lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """(workpack_id, status, rows, error) of every export file, those without lines included.

    A file lacks a required column when its own columns do not have it; a column
    without values is no fault.
    """
    files = exports.judged(file_columns.file_columns(spark, folder, file_format, list(cfg.columns)), file_format, cfg)
    packages = files.groupBy("workpack_id").agg(F.max("error").alias("error"))
    counts = lines.groupBy("workpack_id").agg(F.count(F.lit(1)).alias("rows"))
    return packages.join(counts, "workpack_id", "left").select(
        "workpack_id",
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        "error",
    )
