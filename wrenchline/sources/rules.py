"""The rule table: one row per prefix with every output's resolved mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.config import EngineConfig

_SCHEMA = "prefix string, base string, mhr string, newtask string, tool string, id_method string, coefficient double"


def rules_table(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    rows = []
    for rule in cfg.rules:
        modes = [rule.mode(sheet) or cfg.default_mode for sheet in ("base", "mhr", "newtask", "tool")]
        coefficient = cfg.default_coefficient if rule.coefficient is None else rule.coefficient
        method = rule.id_method or cfg.default_id_method
        rows.append((rule.prefix.upper(), *modes, method, float(coefficient)))
    return spark.createDataFrame(rows, _SCHEMA)


def rules_with_usage(spark: SparkSession, prefix_counts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every rule and every prefix in use, with its lines; no rule means the defaults."""
    rules = rules_table(spark, cfg).withColumn("has_rule", F.lit(True))
    defaults = {name: cfg.default_mode for name in ("base", "mhr", "newtask", "tool")}
    defaults |= {"id_method": cfg.default_id_method, "coefficient": cfg.default_coefficient}
    joined = prefix_counts.join(rules, "prefix", "full")
    filled = joined.fillna({**defaults, "has_rule": False, "lines": 0})
    return filled.select("prefix", *defaults, "has_rule", "lines")
