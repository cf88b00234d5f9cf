"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions import ids
from wrenchline.functions.hours import as_decimal, minutes_to_hours
from wrenchline.functions.text import is_blank, number


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str], source: str = "table") -> None:
    missing = missing_columns(df, columns)
    if missing:
        raise ValueError(f"Missing required columns in {source}: {missing}; expected {list(columns)}")


def has_column(df: DataFrame, column: str) -> bool:
    return not missing_columns(df, [column])


def non_numeric_rows(df: DataFrame, column: str, allow_null: bool = True) -> DataFrame:
    """Rows whose value does not parse as a number."""
    value = F.col(column)
    unreadable = number(value, df.schema[column].dataType).isNull()
    return df.where(unreadable & value.isNotNull() if allow_null else unreadable)


def empty_shares(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Null or blank share of each column against a threshold, in one pass.

    A table without rows passes; an absent column is all empty and fails.
    """
    counts = [
        F.count_if(is_blank(F.col(c))).alias(c) if c in df.columns else F.lit(None).cast("bigint").alias(c)
        for c in columns
    ]
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"), F.col(f"`{c}`").alias("empty"))
            for c in columns
        ]
    )
    long = totals.select(*by, "_rows", F.inline(rows))
    share = (
        F.when(~F.col("present"), F.lit(1.0))
        .when(F.col("_rows") == 0, F.lit(0.0))
        .otherwise(F.col("empty") / F.col("_rows"))
    )
    passes = F.col("present") & (F.col("share") <= F.lit(float(threshold)))
    return long.select(*by, "column", "present", share.alias("share")).select(
        *by, "column", "share", passes.alias("passes")
    )


def bad_sequences(lines: DataFrame) -> DataFrame:
    return lines.where(~ids.is_valid_seq(F.col("seq")))


def reversed_dates(packages: DataFrame) -> DataFrame:
    """Packages whose first line ends before it starts."""
    return packages.where("end_date < start_date")


def coefficient_mismatches(rows: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per package: rows whose adjusted hours are not base x coefficient."""
    require_columns(rows, ["coefficient", "base_hours", "adjusted_hours"], "coefficient check")
    off = F.abs(F.col("adjusted_hours") - F.col("base_hours") * F.col("coefficient"))
    return rows.groupBy("workpack_id").agg(F.count_if(off > tolerance).alias("bad_rows"))


def reconcile(delivered: DataFrame, expected: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.01) -> DataFrame:
    """Delivered values beside expected ones, row by row and from both sides.

    ``finding`` is ``missing`` for an expected row that was not delivered, ``unexpected``
    for a delivered one that nothing asks for, ``different`` beyond the tolerance or
    where just one value is null, and null where all is well. Rows that repeat a key
    are paired in the order of their values.
    """
    repeat = F.row_number().over(Window.partitionBy(*keys).orderBy(value)).alias("_repeat")
    sides = {"delivered": delivered, "expected": expected}
    found = [
        df.select(*keys, repeat, F.col(value).alias(f"{side}_{value}"), F.lit(True).alias(f"_{side}"))
        for side, df in sides.items()
    ]
    ours, theirs = F.col(f"delivered_{value}"), F.col(f"expected_{value}")
    off = ~F.coalesce(F.abs(ours - theirs) <= tolerance, ours.isNull() & theirs.isNull())
    finding = (
        F.when(F.col("_delivered").isNull(), "missing").when(F.col("_expected").isNull(), "unexpected").when(off, "different")
    )
    joined = found[0].join(found[1], [*keys, "_repeat"], "full")
    return joined.withColumn("finding", finding).drop("_delivered", "_expected", "_repeat")


def reconciliation_summary(rows: DataFrame, value: str) -> DataFrame:
    """Per package: rows of each finding and the largest difference of the others."""
    difference = F.abs(F.col(f"delivered_{value}") - F.col(f"expected_{value}"))
    counts = [F.count_if(F.col("finding") == f).alias(f) for f in ("different", "missing", "unexpected")]
    return rows.groupBy("workpack_id").agg(
        F.count_if(F.col("finding").isNull()).alias("matching"), *counts, F.coalesce(F.max(difference), F.lit(0.0)).alias("largest")
    )


def duplicate_sequences(lines: DataFrame) -> DataFrame:
    return lines.groupBy("workpack_id", "seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rule_findings(cfg: EngineConfig, required: Sequence[str] = ("2", "3", "4")) -> list[str]:
    """Problems of the rule settings: prefixes without a mode, odd coefficients."""
    modes, coefficients = cfg.rule_values("base"), cfg.rule_values("coefficient")
    findings = [f"no rule for prefix {p}" for p in required if p not in modes]
    for prefix, value in coefficients.items():
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            findings.append(f"coefficient of prefix {prefix} is not a number")
        elif value < 0 or value > 10:
            findings.append(f"coefficient of prefix {prefix} is unusual: {value}")
    return findings


def oversized_hours(lines: DataFrame) -> DataFrame:
    """Lines whose hours are numbers too large to be summed; sums leave them out."""
    hours = minutes_to_hours(F.col("planned_min"), lines.schema["planned_min"].dataType)
    return lines.where(as_decimal(hours).isNull()).select("workpack_id", "row_no", "seq", "planned_min")
