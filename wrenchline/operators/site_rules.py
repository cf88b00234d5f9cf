"""Rules as data: one job for sites whose rules differ.

A rule names a prefix and may name a site and an output sheet; what it doesn't name
holds for all. Every attribute comes from the most specific rule that sets it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchline.config import CHECKED, IGNORE, SHEETS, EngineConfig
from wrenchline.functions.ids import seq_prefix

RULE_SCHEMA = "site string, sheet string, prefix string, mode string, id_method string, coefficient double"
#: What a rule may leave open, most specific first.
LEVELS = (("site", "sheet"), ("site",), ("sheet",), ())
ATTRIBUTES = ("mode", "id_method", "coefficient")


def rule_rows(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """The settings as rules of all sites, to be extended by those of single sites."""
    rows = []
    for rule in cfg.rules:
        rows.append((None, None, rule.prefix.upper(), rule.base, rule.id_method, rule.coefficient))
        rows += [(None, s, rule.prefix.upper(), getattr(rule, s), None, None) for s in SHEETS[1:] if getattr(rule, s) is not None]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def resolved_rules(keys: DataFrame, rules: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Per (site, prefix) of ``keys``: a mode for each sheet, ID method and coefficient, and the level of the base mode.

    Every key looks for its four kinds of rule of each sheet in one equi join; of
    several rules of one kind the greatest value counts. The level is the number of
    the kind that gave the base mode, 4 where the default did.
    """
    sheets = F.explode(F.array(*[F.lit(s) for s in SHEETS])).alias("sheet")
    wide = keys.select("site", "prefix").distinct().select("*", sheets)
    kinds = [
        F.struct(
            F.lit(i).alias("level"),
            *[(F.col(c) if c in named else F.lit(None).cast("string")).alias(f"_{c}") for c in ("site", "sheet")],
        )
        for i, named in enumerate(LEVELS)
    ]
    of_sites = [i for i, named in enumerate(LEVELS) if "site" in named]
    asked = wide.select("*", F.inline(F.array(*kinds))).where(F.col("site").isNotNull() | ~F.col("level").isin(of_sites))
    found = rules.groupBy("site", "sheet", "prefix").agg(*[F.max(a).alias(a) for a in ATTRIBUTES])
    found = found.select(F.col("site").alias("_rsite"), F.col("sheet").alias("_rsheet"), F.col("prefix").alias("_rprefix"), *ATTRIBUTES)
    same = (
        (F.col("prefix") == F.col("_rprefix"))
        & F.col("_site").eqNullSafe(F.col("_rsite"))
        & F.col("_sheet").eqNullSafe(F.col("_rsheet"))
    )
    joined = asked.join(found, same, "left")

    def first(attribute: str, sheet: str) -> Column:
        there = (F.col("sheet") == sheet) & F.col(attribute).isNotNull()
        return F.min_by(attribute, F.when(there, F.col("level")))

    modes = [F.coalesce(first("mode", s), F.lit(cfg.default_mode)).alias(f"{s}_mode") for s in SHEETS]
    level = F.min(F.when((F.col("sheet") == "base") & F.col("mode").isNotNull(), F.col("level")))
    return joined.groupBy("site", "prefix").agg(
        *modes,
        F.coalesce(first("id_method", "base"), F.lit(cfg.default_id_method)).alias("id_method"),
        F.coalesce(first("coefficient", "base"), F.lit(float(cfg.default_coefficient))).alias("coefficient"),
        F.coalesce(level, F.lit(len(LEVELS))).alias("level"),
    )


def with_site_rules(lines: DataFrame, rules: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Lines (with ``site`` and ``seq``) and what their rules say; a null sequence has the prefix ``nan``.

    Adds ``<sheet>_mode``, ``id_method``, ``coefficient``, ``level``, ``processed`` and
    ``check_ref``. Sites and prefixes in use are few beside the lines, so rules are
    resolved once for each and joined by the size that Spark finds.
    """
    keyed = lines.withColumn("prefix", seq_prefix(F.col("seq")))
    resolved = resolved_rules(keyed, rules, cfg).withColumnsRenamed({"site": "_site", "prefix": "_prefix"})
    joined = keyed.join(resolved, (F.col("prefix") == F.col("_prefix")) & F.col("site").eqNullSafe(F.col("_site")), "left")
    return joined.drop("_site", "_prefix").withColumns(
        {"processed": F.col("base_mode") != IGNORE, "check_ref": F.col("base_mode") == CHECKED}
    )


def site_findings(rules: DataFrame, required: tuple[str, ...] = ("2", "3", "4")) -> DataFrame:
    """(site, prefix, finding) of rules that look wrong.

    Required prefixes without any mode, whether the site's own or of all sites, and
    coefficients below 0 or above 10. The rules of all sites have a null site.
    """
    sites = rules.select("site").distinct()
    wanted = sites.select("site", F.explode(F.array(*[F.lit(p) for p in required])).alias("prefix"))
    modes = rules.where("mode IS NOT NULL").select("site", "prefix").distinct()
    general = modes.where("site IS NULL").select("prefix")
    own = modes.select(F.col("site").alias("_site"), F.col("prefix").alias("_prefix"))
    same = F.col("site").eqNullSafe(F.col("_site")) & (F.col("prefix") == F.col("_prefix"))
    lacking = wanted.join(general, "prefix", "left_anti").join(own, same, "left_anti")
    odd = rules.where("coefficient < 0 OR coefficient > 10").select("site", "prefix", F.lit("unusual coefficient").alias("finding"))
    return lacking.select("site", "prefix", F.lit("no mode").alias("finding")).unionByName(odd.distinct())
