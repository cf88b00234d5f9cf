"""Sequence numbers, task IDs and package headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wrenchline.config import IGNORE, SHEETS, EngineConfig
from wrenchline.functions.text import strip, text_or_nan

# First letter of a package type -> check group.
CHECK_GROUPS = {"A": "A-CHECK", "C": "C-CHECK", "Y": "Y-CHECK"}

_SEQ_FORMAT = r"^\s*[+-]?\d+\s*\.\s*[+-]?\d+\s*(\..*)?$"


def seq_prefix(seq: Column) -> Column:
    """Text before the first dot; a null sequence has the prefix ``nan``."""
    return F.substring_index(text_or_nan(seq), ".", 1)


def rule_value(cfg: EngineConfig, seq: Column, attribute: str) -> Column:
    """Rule attribute for the line's prefix, null without a rule.

    The rules come from the settings (a handful), so they are a literal map and
    not a join: no extra plan node, no exchange. All attributes share one map, so
    a projection that needs several looks the prefix up once.
    """
    if not cfg.rules:
        return F.lit(None)
    rules = [F.lit(item) if isinstance(item, str) else item for pair in _rule_pairs(cfg) for item in pair]
    return F.try_element_at(F.create_map(*rules), seq_prefix(seq)).getField(attribute)


def _rule_pairs(cfg: EngineConfig) -> list[tuple[str, Column]]:
    values = {name: cfg.rule_values(name) for name in (*SHEETS, "id_method", "coefficient")}
    kinds = {"coefficient": "double"}
    return [
        (
            prefix,
            F.struct(
                *[F.lit(values[name].get(prefix)).cast(kinds.get(name, "string")).alias(name) for name in values]
            ),
        )
        for prefix in sorted({rule.prefix.upper() for rule in cfg.rules})
    ]


def mode(cfg: EngineConfig, seq: Column, sheet: str = "base") -> Column:
    return F.coalesce(rule_value(cfg, seq, sheet), F.lit(cfg.default_mode))


def should_process(cfg: EngineConfig, seq: Column, sheet: str = "base") -> Column:
    return mode(cfg, seq, sheet) != IGNORE


def should_check_reference(cfg: EngineConfig, seq: Column, sheet: str = "base") -> Column:
    return mode(cfg, seq, sheet) == "true"


def id_from_title(title: Column, method: Column) -> Column:
    """``-``: before the first "("; ``/``: before the first "/"; else the whole title."""
    cut = (
        F.when(method == "-", F.substring_index(title, "(", 1))
        .when(method == "/", F.substring_index(title, "/", 1))
        .otherwise(title)
    )
    return strip(cut)


def task_id(cfg: EngineConfig, seq: Column, title: Column) -> Column:
    """Task ID of a line; a null title reads as the text ``nan``."""
    method = F.coalesce(rule_value(cfg, seq, "id_method"), F.lit(cfg.default_id_method))
    return id_from_title(text_or_nan(title), method)


def is_valid_task_id(value: Column) -> Column:
    return value.isNotNull() & (F.lower(value) != "nan") & (strip(value) != "")


def is_skipped(cfg: EngineConfig, value: Column) -> Column:
    """Whether the ID contains a configured skip code, in any case."""
    upper = F.upper(value)
    hit = F.lit(False)
    for code in cfg.skip_codes:
        if code.strip():
            hit = hit | upper.contains(code.strip().upper())
    return F.coalesce(hit, F.lit(False))


def seq_coefficient(cfg: EngineConfig, seq: Column, task: Column | None = None) -> Column:
    """Coefficient of the prefix; a skip code in the task ID wins over it."""
    normal = F.coalesce(
        rule_value(cfg, seq, "coefficient").cast("double"), F.lit(float(cfg.default_coefficient))
    )
    if task is None or not cfg.skip_codes:
        return normal
    return F.when(is_skipped(cfg, task), F.lit(float(cfg.skip_coefficient))).otherwise(normal)


def aircraft_name(header: Column, which: str = "first") -> Column:
    """First "-" token of the package header, or all before the last with ``last``."""
    text = strip(header.cast("string"))
    if which == "last":
        return strip(F.regexp_replace(text, r"-[^-]*$", ""))
    return strip(F.substring_index(text, "-", 1))


def package_type(header: Column) -> Column:
    return strip(F.substring_index(strip(header.cast("string")), "-", -1))


def check_group(wp_type: Column) -> Column:
    letter = F.upper(F.substring(strip(wp_type), 1, 1))
    group = F.lit(None).cast("string")
    for first, name in CHECK_GROUPS.items():
        group = F.when(letter == first, name).otherwise(group)
    return group


def is_valid_seq(seq: Column) -> Column:
    """Two integers around a dot; further parts do not matter."""
    return F.coalesce(strip(seq.cast("string")).rlike(_SEQ_FORMAT), F.lit(False))
