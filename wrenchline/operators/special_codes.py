"""Hours per special code."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions.display import percent_text, workers_per_day
from wrenchline.functions.hours import decimal_sum, hours_to_hhmm, rounded
from wrenchline.operators.lines import in_sheet
from wrenchline.operators.packages import (
    expand_header,
    header_struct,
    with_aircraft_type,
    with_bonus,
)


def usable_special_codes(lines: DataFrame) -> DataFrame:
    """Whether a package has any special code at all."""
    return lines.groupBy("workpack_id").agg((F.count("special_code") > 0).alias("usable"))


def special_code_hours(kept: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Adjusted hours per package and code, ranked, with the package's own figures.

    Kept lines are summed per (package, code) first; the package total, header
    and rank are windows over those sums, so the lines are read and shuffled
    once. Lines without a code count in the package total only.
    """
    counts = F.col("processed") & in_sheet(cfg, "mhr")
    first = F.struct(F.col("row_no").alias("row_no"), header_struct(kept).alias("header"))
    per_code = kept.groupBy("workpack_id", "special_code").agg(
        F.min_by(first, F.col("row_no")).alias("first"),
        F.count_if(counts).alias("n"),
        decimal_sum(F.when(counts, F.col("adjusted_hours"))).alias("sum"),
    )
    package = Window.partitionBy("workpack_id")
    listed = F.col("special_code").isNotNull() & (F.col("n") > 0)
    ranking = package.orderBy(F.desc("listed"), F.desc("hours"), "special_code")
    figures = (
        per_code.withColumns(
            {
                "listed": listed,
                "hours": rounded(F.col("sum")),
                "adjusted_hours": F.coalesce(rounded(F.sum("sum").over(package)), F.lit(0.0)),
                "header": F.min("first").over(package).getField("header"),
            }
        )
        .withColumn("rank", F.row_number().over(ranking))
        .where("listed")
        .drop("listed", "first", "n", "sum")
    )
    out = expand_header(figures, cfg)
    return out.withColumn("hours_per_day", F.when(F.col("days") > 0, F.col("hours") / F.col("days")))


def special_code_summary(code_hours: DataFrame, total: str = "adjusted_hours") -> DataFrame:
    """Share of a given total per code; nothing for a total of 0 or less."""
    return code_hours.where(F.col(total) > 0).select(
        "workpack_id",
        F.col("special_code").alias("code"),
        "hours",
        (F.col("hours") / F.col(total) * 100).alias("pct"),
    )


def special_code_table(
    kept: DataFrame, registrations: DataFrame, bonus: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Report table: one row per code and a TOTAL row per package.

    TOTAL is the final total with bonus and lines without a code, so the codes
    need not add up to 100 %. Its row is added beside the first-ranked code.
    """
    codes = with_bonus(
        with_aircraft_type(special_code_hours(kept, cfg), registrations), bonus
    ).withColumn("total_hours", F.col("adjusted_hours") + F.col("bonus_hours"))

    total, days = F.col("total_hours"), F.col("days")
    share = F.when(total > 0, F.col("hours") / total * 100).otherwise(0.0)
    code_row = F.struct(
        F.col("rank"),
        F.col("special_code").cast("string").alias("label"),
        F.col("hours"),
        F.col("hours_per_day"),
        share.alias("pct"),
    )
    total_row = F.struct(
        F.lit(0).alias("rank"),
        F.lit("TOTAL").alias("label"),
        total.alias("hours"),
        F.when(days > 0, total / days).alias("hours_per_day"),
        F.lit(100.0).alias("pct"),
    )
    rows = F.when(F.col("rank") == 1, F.array(code_row, total_row)).otherwise(F.array(code_row))
    return (
        codes.select("workpack_id", F.inline(rows))
        .withColumn("line", F.when(F.col("label").isNotNull() & (F.col("rank") > 0), F.col("rank")))
        .select(
            "workpack_id",
            "line",
            "label",
            hours_to_hhmm(F.col("hours")).alias("hhmm"),
            hours_to_hhmm(F.col("hours_per_day")).alias("avg_hhmm"),
            workers_per_day(F.col("hours_per_day"), cfg.shift_hours).alias("workers"),
            "pct",
            percent_text(F.col("pct")).alias("pct_text"),
        )
    )
