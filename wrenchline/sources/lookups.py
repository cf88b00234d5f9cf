"""Reference tables from workbooks and text files."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, DoubleType, IntegralType, LongType, NumericType, StringType, TimestampNTZType,
)

from wrenchline.functions.text import strip
from wrenchline.operators.new_tasks import reference_ids
from wrenchline.sources import workbook

log = logging.getLogger(__name__)

# Sheet and column names of the standard reference files.
TASK_SHEET, TASK_COLUMN = "Task", "Taskcard Number"
EO_SHEET, EO_COLUMN = "EO", "EO"
REGISTRATION_COLUMNS = {"regis": "Regis", "ac_type": "Type"}
BONUS_KEYS = {"aircraft_code": "AircraftCode", "product_code": "ProductCode"}
BONUS_HOURS = {"hours": "Hours", "hours2": "Hours2"}
TYPE_COLUMNS = {
    "aircraft_code": "AircraftCode",
    "check_group": "CheckGroup",
    "func_group": "FuncGroup",
    "coeff": "Coeff",
}
ACTIVE_COLUMN = "IsActive"


def sheet_columns(cells: DataFrame) -> set[str]:
    """Distinct column names over all sheets (as many as the files have columns)."""
    names = cells.where("columns IS NOT NULL").select(F.explode("columns").alias("name")).distinct()
    return {row["name"] for row in names.collect()}


def _order():
    return F.struct("sheet_no", "row_no").alias("row_no")


def _bound(columns: dict[str, str]):
    return [workbook.text_of(source).alias(name) for name, source in columns.items()]


def reference_from_cells(cells: DataFrame) -> DataFrame:
    """(kind, id) of both ID sheets; a missing sheet or column gives no IDs."""
    rows = workbook.data_rows(cells)

    def column(sheet: str, name: str) -> DataFrame:
        return rows.where(F.col("sheet") == sheet).select(workbook.text_of(name).alias("id"))

    return reference_ids(column(TASK_SHEET, TASK_COLUMN), column(EO_SHEET, EO_COLUMN))


def registrations_from_cells(cells: DataFrame) -> DataFrame:
    """Registrations of the first sheet; empty when a column is missing."""
    present = workbook.has(REGISTRATION_COLUMNS["regis"]) & workbook.has(REGISTRATION_COLUMNS["ac_type"])
    rows = workbook.data_rows(cells).where((F.col("sheet_no") == 0) & present)
    return rows.select(*_bound(REGISTRATION_COLUMNS), _order())


def bonus_from_cells(cells: DataFrame) -> DataFrame:
    """Bonus rows of every sheet that has both keys and at least one hour column."""
    has = workbook.has
    usable = (
        has(BONUS_KEYS["aircraft_code"])
        & has(BONUS_KEYS["product_code"])
        & (has(BONUS_HOURS["hours"]) | has(BONUS_HOURS["hours2"]))
    )
    # A sheet without the flag column counts as active throughout.
    active = ~has(ACTIVE_COLUMN) | workbook.is_true(ACTIVE_COLUMN)
    return workbook.data_rows(cells).where(usable).select(
        "sheet", _order(), *_bound(BONUS_KEYS), *_bound(BONUS_HOURS), active.alias("is_active")
    )


def type_coefficients_from_cells(cells: DataFrame) -> DataFrame:
    """Rows of all sheets as one table, columns aligned by name.

    The flag column counts for all sheets once any sheet has it.
    """
    columns = sheet_columns(cells)
    missing = [c for c in TYPE_COLUMNS.values() if c not in columns]
    rows = workbook.data_rows(cells)
    if missing:
        log.warning("type coefficient sheets lack %s; no type coefficients", missing)
        rows = rows.where(F.lit(False))
    active = workbook.is_true(ACTIVE_COLUMN) if ACTIVE_COLUMN in columns else F.lit(True)
    return rows.select(_order(), *_bound(TYPE_COLUMNS), active.alias("is_active"))


def common_type(kinds: Sequence[DataType]) -> DataType:
    """One type that holds values of all: numbers as bigint or double, dates as timestamps, the rest as text."""
    distinct = set(kinds)
    if len(distinct) == 1:
        return distinct.pop()
    if all(isinstance(k, NumericType) for k in distinct):
        return LongType() if all(isinstance(k, IntegralType) for k in distinct) else DoubleType()
    if all(isinstance(k, (DateType, TimestampNTZType)) for k in distinct):
        return TimestampNTZType()
    return StringType()


def union_sheets(sheets: dict[str, DataFrame]) -> DataFrame:
    """Sheets held as DataFrames in one table, columns aligned by name.

    A sheet without a column has nulls there; a column of several types gets one
    that holds them all. ``sheet`` and ``sheet_no`` tell where a row comes from.
    """
    if not sheets:
        raise ValueError("no sheets")
    kinds: dict[str, list[DataType]] = {}
    for df in sheets.values():
        for field in df.schema:
            kinds.setdefault(field.name, []).append(field.dataType)
    chosen = {name: common_type(found) for name, found in kinds.items()}
    frames = [
        df.select(*[F.col(f"`{c}`").cast(chosen[c]).alias(c) for c in df.columns], F.lit(name).alias("sheet"), F.lit(number).alias("sheet_no"))
        for number, (name, df) in enumerate(sheets.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ignore_items(spark: SparkSession, path: str) -> DataFrame:
    """Ignore list: one item a line, trimmed and lower-cased, blanks and # lines out.

    Without the file nothing is ignored.
    """
    if is_missing(spark, path):
        log.warning("no ignore list at %s", path)
        return spark.createDataFrame([], "item string")
    return ignore_items_of(spark.read.text(path))


def is_missing(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return True
    return False


def ignore_items_of(text: DataFrame) -> DataFrame:
    """Items of raw lines (``value``)."""
    return (
        text.select(strip(F.col("value")).alias("item"))
        .where((F.col("item") != "") & ~F.startswith(F.col("item"), F.lit("#")))
        .select(F.lower("item").alias("item"))
        .distinct()
    )
