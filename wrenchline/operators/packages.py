"""Package-level steps: header, aircraft type, bonus, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig
from wrenchline.functions import ids
from wrenchline.functions.hours import decimal_sum, hours_to_hhmm, inclusive_days, rounded, to_timestamp
from wrenchline.functions.text import strip, text_or_nan
from wrenchline.operators.lines import in_sheet

HEADER_FIELDS = ("wpno", "start_date", "end_date")


def header_struct(df: DataFrame) -> Column:
    """The header fields as the line table has them, null where it lacks one."""
    fields = [F.col(f) if f in df.columns else F.lit(None).cast("string") for f in HEADER_FIELDS]
    return F.struct(*[field.alias(name) for field, name in zip(fields, HEADER_FIELDS)])


def expand_header(packages: DataFrame, cfg: EngineConfig, header: str = "header") -> DataFrame:
    """Header struct to aircraft name, package type, check group and duration."""
    kinds = {field.name: field.dataType for field in packages.schema[header].dataType}
    wpno = F.col(f"{header}.wpno")
    start, end = [to_timestamp(F.col(f"{header}.{d}"), kinds[d]) for d in ("start_date", "end_date")]
    named = packages.withColumns(
        {
            "ac_name": ids.aircraft_name(wpno, cfg.aircraft_name_part),
            "wp_type": ids.package_type(wpno),
            "start_date": start,
            "end_date": end,
        }
    ).drop(header)
    return named.withColumns(
        {
            "check_group": ids.check_group(F.col("wp_type")),
            "days": inclusive_days(F.col("start_date"), F.col("end_date")),
        }
    )


def package_headers(lines: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Header of each package from its first line."""
    first = F.min_by(header_struct(lines), F.col("row_no")).alias("header")
    return expand_header(lines.groupBy("workpack_id").agg(first), cfg)


def registration_table(rows: DataFrame) -> DataFrame:
    """Registration -> aircraft type, trimmed; the last row of a registration wins."""
    keyed = rows.select(
        strip(text_or_nan(F.col("regis"))).alias("regis"),
        strip(text_or_nan(F.col("ac_type"))).alias("ac_type"),
        "row_no",
    )
    return keyed.groupBy("regis").agg(F.max_by("ac_type", "row_no").alias("ac_type"))


def with_aircraft_type(packages: DataFrame, registrations: DataFrame) -> DataFrame:
    """Aircraft type by registration, null without a match.

    Lookup joins carry no broadcast hint: these tables come from data, so Spark's
    own size check decides, at planning and again at run time, and a sort-merge
    join with skew splitting takes over beyond it.
    """
    lookup = registrations.where("regis != ''").withColumnRenamed("regis", "ac_name")
    return packages.join(lookup, "ac_name", "left")


def with_bonus(packages: DataFrame, bonus: DataFrame) -> DataFrame:
    """Bonus hours by (package type, aircraft type), 0 without a match."""
    lookup = bonus.select(
        F.col("product_code").alias("wp_type"), F.col("aircraft_code").alias("ac_type"), "bonus_hours"
    )
    joined = packages.join(lookup, ["wp_type", "ac_type"], "left")
    return joined.withColumn("bonus_hours", F.coalesce("bonus_hours", F.lit(0.0)))


def package_sums(kept: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Header and hour sums of every package, 0 where no line counts.

    Takes the kept lines of ``lines.kept_lines``.
    """
    counts = F.col("processed") & in_sheet(cfg, "mhr")
    base = decimal_sum(F.when(counts, F.col("base_hours")))
    adjusted = decimal_sum(F.when(counts, F.col("adjusted_hours")))
    zero = F.lit(0.0)
    sums = kept.groupBy("workpack_id").agg(
        F.min_by(header_struct(kept), F.col("row_no")).alias("header"),
        F.coalesce(rounded(base), zero).alias("base_hours"),
        F.coalesce(rounded(adjusted), zero).alias("adjusted_hours"),
        F.coalesce(rounded(adjusted - base), zero).alias("coefficient_effect"),
    )
    return expand_header(sums, cfg)


def package_totals(
    kept: DataFrame,
    registrations: DataFrame,
    bonus: DataFrame,
    cfg: EngineConfig,
    all_packages: DataFrame | None = None,
) -> DataFrame:
    """Final total = adjusted hours + bonus, the bonus once per package.

    ``all_packages`` (workpack_id) adds the packages without any line, with hours of 0.
    """
    sums = package_sums(kept, cfg)
    if all_packages is not None:
        hours = ["base_hours", "adjusted_hours", "coefficient_effect"]
        sums = all_packages.select("workpack_id").distinct().join(sums, "workpack_id", "left").fillna(0.0, hours)
    return with_total(with_bonus(with_aircraft_type(sums, registrations), bonus))


def with_total(sums: DataFrame) -> DataFrame:
    totals = sums.withColumn("total_hours", F.col("adjusted_hours") + F.col("bonus_hours"))
    return totals.withColumns(
        {
            "base_hhmm": hours_to_hhmm(F.col("base_hours")),
            "total_hhmm": hours_to_hhmm(F.col("total_hours")),
        }
    )
