"""Display forms used in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wrenchline.functions.text import strip


def clean(value: Column) -> Column:
    return F.coalesce(strip(value.cast("string")), F.lit(""))


def percent_text(percent: Column, places: int = 1) -> Column:
    """``12.3%``: rounded half-even on the exact binary value, no digit groups.

    ``format_string`` would round half-up on the shortest decimal text.
    """
    pattern = "0." + "0" * places if places else "0"
    return F.concat(F.call_function("format_number", percent, F.lit(pattern)), F.lit("%"))


def format_percentage(fraction: Column, places: int = 1) -> Column:
    """Fraction to percent text; null is ``0.0%`` whatever the places."""
    share = fraction.cast("double")
    known = share.isNotNull() & ~F.isnan(share)
    return F.when(known, percent_text(share * 100, places)).otherwise("0.0%")


def truncate(value: Column, length: int = 30, suffix: str = "...") -> Column:
    """Cut to ``length`` with the suffix included, where the text is longer."""
    keep = length - len(suffix)
    if keep >= 0:
        longer = rf"(?s)^(.{{{keep}}}).{{{length - keep + 1},}}\z"
    else:  # the suffix alone is longer: a negative count cuts from the end
        longer = rf"(?s)^(?=.{{{length + 1},}})(.*?).{{0,{-keep}}}\z"
    literal = suffix.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(clean(value), longer, "$1" + literal)


def seq_display(seq: Column) -> Column:
    return F.coalesce(strip(seq.cast("string")), F.lit("N/A"))


def task_id_display(task: Column) -> Column:
    return F.when(task.isNull() | (F.lower(task) == "nan"), "(No ID)").otherwise(strip(task))


def special_code_display(code: Column) -> Column:
    text = strip(code.cast("string"))
    return F.when(text.isNull() | F.lower(text).isin("", "nan"), "(No Code)").otherwise(text)


def tool_type(flag: Column) -> Column:
    """Y is a tool, N a spare, null unknown, any other flag stays as it is."""
    code = F.upper(strip(flag.cast("string")))
    return (
        F.when(flag.isNull(), "Unknown")
        .when(code == "Y", "Tool")
        .when(code == "N", "Spare")
        .otherwise(flag.cast("string"))
    )


def workers_per_day(hours_per_day: Column, shift_hours: float = 8) -> Column:
    """Whole workers a day; below one the text names 8 h whatever the shift is."""
    workers = hours_per_day / F.lit(float(shift_hours))
    whole = F.concat(F.floor(workers).cast("string"), F.lit(" worker(s)"))
    return F.when(workers < 1, "< 8h/day").when(workers.isNotNull(), whole)
