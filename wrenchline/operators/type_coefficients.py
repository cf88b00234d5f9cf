"""Coefficients by (check group, aircraft, function), the alternative to the sequence rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions.hours import as_decimal, decimal_sum, rounded
from wrenchline.functions.text import is_blank, lookup_key, number, strip
from wrenchline.operators.bonus import active_rows
from wrenchline.operators.keep_first import first_n, last_value
from wrenchline.operators.lines import mhr_rows, with_base_hours

KEYS = ["check_group", "aircraft_code", "func_group"]


def type_coefficient_table(rows: DataFrame) -> DataFrame:
    """Active rows with full keys and a numeric value; the last row of a key wins."""
    keyed = active_rows(rows).select(
        *[lookup_key(F.col(key)).alias(key) for key in KEYS],
        number(F.col("coeff"), rows.schema["coeff"].dataType).alias("type_coefficient"),
        "row_no",
    )
    return last_value(keyed.dropna(subset=[*KEYS, "type_coefficient"]), KEYS, "type_coefficient")


def table_statistics(table: DataFrame) -> DataFrame:
    """Aircraft, and (aircraft, function) pairs, per check group.

    The table holds one row per key, so the pairs are its rows.
    """
    return table.groupBy("check_group").agg(
        F.count_distinct("aircraft_code").alias("aircrafts"), F.count(F.lit(1)).alias("functions")
    )


def counted_rows(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The rows the coefficients apply to: counted rows, or all lines."""
    if cfg.type_coefficient_per_seq:
        return mhr_rows(lines, cfg)
    return with_base_hours(lines)


def with_type_coefficient(
    rows: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Type coefficient per row, 1.0 without a match.

    ``packages`` has one row per package, ``table`` one per key, so both joins
    keep the row count. Rows may be lines or anything summed per (package,
    function), since the coefficient is the same within those.
    """
    default = F.lit(float(cfg.default_type_coefficient))
    if "func_group" not in rows.columns:
        return rows.withColumn("type_coefficient", default)
    groups = packages.select("workpack_id", "check_group", strip(F.col("ac_type")).alias("aircraft_code"))
    lookup = table.withColumnRenamed("func_group", "_func")
    keyed = rows.withColumn("_func", strip(F.col("func_group").cast("string")))
    joined = keyed.join(groups, "workpack_id", "left").join(
        lookup, ["check_group", "aircraft_code", "_func"], "left"
    )
    return joined.withColumn("type_coefficient", F.coalesce("type_coefficient", default)).drop("_func")


def type_coefficient_lines(
    lines: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig
) -> DataFrame:
    rows = with_type_coefficient(counted_rows(lines, cfg), packages, table, cfg)
    return rows.withColumn("adjusted_hours", F.col("base_hours") * F.col("type_coefficient"))


def with_type_hours(
    kept: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Kept lines with their hours adjusted by type instead of by sequence."""
    rows = with_type_coefficient(kept, packages, table, cfg)
    return rows.withColumns(
        {
            "coefficient": F.col("type_coefficient"),
            "adjusted_hours": F.col("base_hours") * F.col("type_coefficient"),
        }
    )


def hours_per_function(rows: DataFrame) -> DataFrame:
    return rows.groupBy("workpack_id", "func_group").agg(
        F.coalesce(decimal_sum(F.col("base_hours")), as_decimal(F.lit(0.0))).alias("base_hours")
    )


def additional_hours(
    counted: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Adjusted less base hours per package and function.

    Lines are summed per (package, function) before any join: the coefficient is
    constant there, so base x coefficient - base is the sum over the lines. Both
    hours stay decimals; results round them once.
    """
    rows = with_type_coefficient(hours_per_function(counted), packages, table, cfg)
    base = F.col("base_hours").cast("double")
    return rows.withColumn("additional_hours", as_decimal(base * F.col("type_coefficient") - base))


def type_coefficient_breakdown(
    lines: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig, counted: DataFrame | None = None
) -> DataFrame:
    """Additional hours of named functions, where they are more than 0.01 away from 0.

    ``counted``: the rows of ``counted_rows``, where they are at hand.
    """
    rows = additional_hours(counted_rows(lines, cfg) if counted is None else counted, packages, table, cfg)
    rows = rows.withColumn("additional_hours", rounded(F.col("additional_hours")))
    named = rows.where(~is_blank(F.col("func_group")) & (F.abs("additional_hours") > 0.01))
    return named.select("workpack_id", "func_group", "additional_hours")


def type_coefficient_totals(
    lines: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig, counted: DataFrame | None = None
) -> DataFrame:
    """Additional hours of each package over all its functions, named or not."""
    rows = additional_hours(counted_rows(lines, cfg) if counted is None else counted, packages, table, cfg)
    return rows.groupBy("workpack_id").agg(
        rounded(F.sum("base_hours")).alias("base_hours"),
        F.coalesce(rounded(F.sum("additional_hours")), F.lit(0.0)).alias("additional_hours"),
    )


def first_seen_functions(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Distinct functions of a package with the row they first occur in."""
    rows = counted_rows(lines, cfg)
    return rows.groupBy("workpack_id", "func_group").agg(F.min("row_no").alias("first_row"))


def function_map(
    lines: DataFrame, packages: DataFrame, table: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Distinct (function, coefficient) pairs of each package: all, or the first few where a size is set.

    A function has one coefficient in a package, so distinct functions are taken
    before the joins.
    """
    first = first_seen_functions(lines, cfg)
    if cfg.function_map_size is not None:
        first = first_n(first, ["workpack_id"], ["first_row"], cfg.function_map_size)
    return with_type_coefficient(first, packages, table, cfg)
