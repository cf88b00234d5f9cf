"""Settings of a run from a JSON file."""

from __future__ import annotations

import dataclasses
import json
import logging

from pyspark.sql import SparkSession

from wrenchline.config import DEFAULT_CONFIG, EngineConfig, SeqRule
from wrenchline.operators.quality import rule_findings

log = logging.getLogger(__name__)


def _checked(name: str, value, default):
    """The value in the type of the default; numbers may be whole, and null only where the default is."""
    if isinstance(default, tuple):
        if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
            raise ValueError(f"setting {name} must be a list of texts")
        return tuple(value)
    if name == "function_map_size":
        kinds = (int, type(None))
    elif isinstance(default, float):
        kinds = (int, float)
    else:
        kinds = (int, float) if name in ("high_hours", "shift_hours") else (type(default),)
    if not isinstance(value, kinds) or (isinstance(value, bool) and not isinstance(default, bool)):
        raise ValueError(f"setting {name} has a wrong type: {value!r}")
    return value


def config_of(settings: dict) -> EngineConfig:
    """Settings by field name; fields that are not given keep their standard values.

    ``rules`` is a list of objects with the fields of ``SeqRule``. Unknown names, wrong
    types and coefficients that are no numbers are errors; other findings are logged.
    """
    known = {f.name for f in dataclasses.fields(EngineConfig)}
    if unknown := sorted(set(settings) - known):
        raise ValueError(f"unknown settings: {unknown}; expected some of {sorted(known)}")
    values = {}
    for name, value in settings.items():
        if name == "rules":
            try:
                values[name] = tuple(SeqRule(**rule) for rule in value)
            except TypeError as error:
                raise ValueError(f"rules must be objects with the fields of a rule: {error}") from error
        else:
            values[name] = _checked(name, value, getattr(DEFAULT_CONFIG, name))
    cfg = dataclasses.replace(DEFAULT_CONFIG, **values)
    if cfg.coefficient_system not in ("seq", "type"):
        raise ValueError(f"setting coefficient_system must be seq or type, not {cfg.coefficient_system!r}")
    for finding in rule_findings(cfg):
        if "not a number" in finding:
            raise ValueError(finding)
        log.warning("settings: %s", finding)
    return cfg


def read_settings(spark: SparkSession, path: str) -> EngineConfig:
    """Settings from a JSON file in any store that Spark reads."""
    text = spark.read.text(path, wholetext=True).first()
    return config_of(json.loads(text["value"]) if text else {})
