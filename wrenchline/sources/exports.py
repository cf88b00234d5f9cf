"""Folders of exports whose files differ, and of which some may be broken.

Each file is judged by its own columns: one that cannot be read or lacks a required
column is ``failed``, and the others go on. Columns are found by name, whatever
their place in a file.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wrenchline.config import REQUIRED_COLUMNS, TOOL_COLUMNS, EngineConfig
from wrenchline.sources import file_columns as heads

Stage = Callable[[DataFrame, str], DataFrame]
FLAGS = ("has_event", "has_tool_columns", "has_dates")


@dataclass(frozen=True)
class Exports:
    """``lines`` of the readable files, and (workpack_id, status, rows, error) of all."""

    lines: DataFrame
    status: DataFrame


def _export_names(cfg: EngineConfig) -> dict[str, str]:
    """{logical name: column name in the files}."""
    return {logical: name for name, logical in cfg.columns.items()}


def _all_in_file(cfg: EngineConfig, logical: tuple[str, ...]) -> Column:
    own = _export_names(cfg)
    if not set(logical) <= set(own):
        return F.lit(False)
    return reduce(lambda a, b: a & b, [heads.has_column(own[n]) for n in logical])


def judged(files: DataFrame, file_format: str, cfg: EngineConfig) -> DataFrame:
    """Files with the flags of their optional columns, and an ``error`` where a required one is missing."""
    own = _export_names(cfg)
    missing = F.array_join(heads.missing_columns([own[n] for n in REQUIRED_COLUMNS]), ", ")
    # A json file without lines has no keys; nothing is wrong with it.
    lacking = (missing != "") & ((F.size("columns") > 0) if file_format == "json" else F.lit(True))
    odd = F.filter("columns", lambda c: c["name"].isin(list(own.values())) & c["type"].startswith(heads.UNREADABLE))
    error = F.coalesce(
        "error",
        F.when(lacking, F.concat(F.lit("Missing required columns: "), missing)),
        F.when(F.size(odd) > 0, F.concat(F.lit("Columns of other types: "), F.array_join(F.transform(odd, lambda c: c["name"]), ", "))),
    )
    return files.withColumns(
        {
            "error": error,
            "has_event": _all_in_file(cfg, ("event",)),
            "has_tool_columns": _all_in_file(cfg, TOOL_COLUMNS),
            "has_dates": _all_in_file(cfg, ("start_date", "end_date")),
        }
    )


def _csv_rows(spark: SparkSession, folder: str | list[str], good: DataFrame, cfg: EngineConfig, per: str) -> DataFrame:
    """Lines parsed by place and mapped to names by the head of their file; repeats of the head are no lines."""
    own = _export_names(cfg)
    place = lambda name: F.nullif(F.array_position(heads.names(), name), F.lit(0)).cast("int").alias(name)
    bound = good.select("*", F.size("columns").alias("width"), F.struct(*[place(n) for n in own.values()]).alias("at"))
    widest = bound.agg(F.max("width")).first()[0] or 1
    fields = ", ".join(f"c{i} string" for i in range(widest + 1))
    lines = heads.text_lines(spark, folder, "csv", per).join(bound, "file").where("value != head")
    cells = lines.withColumn("cells", F.from_csv("value", fields))
    excess = F.coalesce(*[F.when(F.col("width") <= i, F.col(f"cells.c{i}")) for i in range(widest + 1)]).isNotNull()
    cells = cells.withColumn("excess", excess).withColumn("cells", F.array(*[F.col(f"cells.c{i}") for i in range(widest + 1)]))
    values = [F.try_element_at("cells", F.col("at").getField(name)).alias(logical) for logical, name in own.items()]
    return cells.select("file", "workpack_id", *FLAGS, F.struct("split", "place").alias("row_no"), "excess", *values)


def _json_rows(spark: SparkSession, folder: str | list[str], good: DataFrame, cfg: EngineConfig, per: str) -> DataFrame:
    own = _export_names(cfg)
    schema = StructType([StructField(name, StringType()) for name in own.values()])
    lines = heads.text_lines(spark, folder, "json", per).join(good, "file").withColumn("cells", F.from_json("value", schema))
    values = [F.col("cells").getField(name).alias(logical) for logical, name in own.items()]
    return lines.select("file", "workpack_id", *FLAGS, F.struct("split", "place").alias("row_no"), F.lit(False).alias("excess"), *values)


def _parquet_rows(spark: SparkSession, folder: str | list[str], good: DataFrame, cfg: EngineConfig, per: str) -> DataFrame:
    """Files of one set of types are read with those; a column of several types becomes text.

    What is collected are the types of each wanted column and their combinations, not files.
    """
    own = _export_names(cfg)
    table = heads.column_table(good).where(F.col("name").isin(list(own.values())))
    types = {r["name"]: sorted(r["types"]) for r in table.groupBy("name").agg(F.collect_set("type").alias("types")).collect()}
    mixed = sorted(name for name, kinds in types.items() if len(kinds) > 1)
    of = lambda name: F.element_at(F.filter("columns", lambda c: c["name"] == name), 1).getField("type")
    first = lambda name: F.when(heads.has_column(name), of(name))
    variant = F.array(*[first(name) for name in mixed]) if mixed else F.array().cast("array<string>")
    good = good.withColumn("variant", variant)
    variants = [r[0] for r in good.select("variant").distinct().collect()] if mixed else [[]]

    def read(kinds: list[str | None]) -> DataFrame:
        chosen = dict(zip(mixed, kinds, strict=True))
        fields = [f"`{name}` {chosen.get(name) or types[name][0]}" for name in types]
        # Files of other types are skipped here, as damaged ones are; the rows that remain are counted against the footers.
        source = heads.reader(spark, "parquet", per).option("ignoreCorruptFiles", True)
        rows = source.schema(", ".join(fields)).format("parquet").load(folder) if fields else None
        files = good.where(F.col("variant").eqNullSafe(F.lit(kinds).cast("array<string>")) if mixed else F.lit(True))
        if rows is None:
            return files.select("file", "workpack_id", *FLAGS, F.lit(0).cast("bigint").alias("row_no"), F.lit(False).alias("excess")).where("false")
        values = [
            (F.col(f"`{name}`").cast("string") if name in mixed else F.col(f"`{name}`")).alias(logical)
            for logical, name in own.items()
            if name in types
        ]
        rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_no"), *values)
        flags = files.select("file", "workpack_id", *FLAGS)
        return rows.join(flags, "file").withColumn("excess", F.lit(False))

    rows = reduce(lambda a, b: a.unionByName(b), [read(v) for v in variants])
    absent = {logical: F.lit(None).cast("string") for logical, name in own.items() if name not in types}
    return rows.withColumns(absent)


_ROWS = {"csv": _csv_rows, "json": _json_rows, "parquet": _parquet_rows}


def read_folder(
    spark: SparkSession,
    folder: str | list[str],
    file_format: str,
    cfg: EngineConfig,
    stage: Stage = lambda df, name: df,
    per: str = "file",
) -> Exports:
    """Line table of a folder of csv, json or parquet files, and what became of every package.

    ``stage`` can store a table under a name and return the stored one; files and
    lines are used more than once. With ``per="folder"`` all files of a subfolder are
    one package, in the order of their names. Text formats are read twice where keys
    are needed (json), csv heads and Parquet footers are opened by themselves.

    A package fails as a whole: when one of its files cannot be read, lacks a required
    column, has a line that is no JSON object or has more values than its head, or gave
    fewer rows than its footer tells. Its lines are not among ``lines``. A damaged
    compressed text file is an error of the run. Files without bytes are not listed.
    """
    if file_format not in _ROWS:
        raise ValueError(f"unknown format {file_format!r}; expected one of {tuple(_ROWS)}")
    found = heads.file_columns(spark, folder, file_format, list(cfg.columns), per)
    files = stage(judged(found, file_format, cfg), "export_files")
    good = files.where("error IS NULL").drop("error")
    rows = _ROWS[file_format](spark, folder, good, cfg, per)
    if per == "folder":
        rows = rows.withColumn("row_no", F.struct("file", F.col("row_no").alias("row")))
    for date in {"start_date", "end_date"}.intersection(_export_names(cfg)):
        rows = rows.withColumn(date, F.when(F.col("has_dates"), F.col(date)))
    read = stage(rows.drop("file", "has_dates"), "exports")

    counts = read.groupBy("workpack_id").agg(F.count("*").alias("n"), F.count_if("excess").alias("long"))
    packages = files.groupBy("workpack_id").agg(F.max("error").alias("error"), F.sum("rows").alias("told")).join(counts, "workpack_id", "left")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    error = F.coalesce(
        "error",
        F.when(F.col("long") > 0, F.concat(F.col("long").cast("string"), F.lit(" lines with more values than the head"))),
        F.when(F.col("told") != n, F.concat_ws(" ", F.lit("read"), n.cast("string"), F.lit("of"), F.col("told").cast("string"), F.lit("lines"))),
    )
    status = stage(
        packages.select(
            "workpack_id", F.when(error.isNull(), "ok").otherwise("failed").alias("status"), n.alias("rows"), error.alias("error")
        ),
        "export_status",
    )
    failed = status.where("status = 'failed'").select("workpack_id")
    return Exports(read.drop("excess").join(failed, "workpack_id", "left_anti"), status)
