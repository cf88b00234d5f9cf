"""Bonus hour norms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from wrenchline.functions.hours import hours_sum
from wrenchline.functions.text import lookup_key, number, strip, text_or_nan
from wrenchline.operators.keep_first import keep_first


def active_rows(rows: DataFrame, column: str = "is_active") -> DataFrame:
    """Rows whose flag is true or 1; null and text are not, no column means all."""
    if column not in rows.columns:
        return rows
    flag, dtype = F.col(column), rows.schema[column].dataType
    if isinstance(dtype, BooleanType):
        return rows.where(flag)
    if isinstance(dtype, NumericType):
        return rows.where(flag == 1)
    return rows.where(F.lit(False))


def _row_bonus(rows: DataFrame) -> Column:
    present = [c for c in ("hours", "hours2") if c in rows.columns]
    if not present:
        raise ValueError("bonus rows need hours or hours2")
    parts = [F.coalesce(number(F.col(c), rows.schema[c].dataType), F.lit(0.0)) for c in present]
    return parts[0] if len(parts) == 1 else parts[0] + parts[1]


def bonus_table(rows: DataFrame) -> DataFrame:
    """Bonus hours per (package type, aircraft), summed over all sheets."""
    keyed = active_rows(rows).select(
        lookup_key(F.col("product_code")).alias("product_code"),
        lookup_key(F.col("aircraft_code")).alias("aircraft_code"),
        _row_bonus(rows).alias("bonus"),
    )
    named = keyed.where("product_code is not null and aircraft_code is not null")
    return named.groupBy("product_code", "aircraft_code").agg(
        hours_sum(F.col("bonus")).alias("bonus_hours")
    )


def first_norm_per_sheet(rows: DataFrame) -> DataFrame:
    """First active row of each (sheet, package type, aircraft)."""
    keyed = active_rows(rows).select(
        "sheet",
        "row_no",
        strip(text_or_nan(F.col("product_code"))).alias("wp_type"),
        strip(text_or_nan(F.col("aircraft_code"))).alias("ac_type"),
        _row_bonus(rows).alias("bonus_hours"),
    )
    return keep_first(keyed, ["sheet", "wp_type", "ac_type"]).drop("row_no")


def bonus_breakdown(packages: DataFrame, rows: DataFrame) -> DataFrame:
    """Bonus per package and source sheet, where above 0.

    Takes the first matching row of a sheet, while the bonus total sums them all,
    so the two may differ.
    """
    norms = first_norm_per_sheet(rows).where("bonus_hours > 0")
    return packages.join(norms, ["wp_type", "ac_type"]).select("workpack_id", "sheet", "bonus_hours")
