"""Maintenance labour-hour analytics as Spark DataFrame operators.

Every work package lives in one DataFrame keyed by ``workpack_id``; each
operator is a plain ``DataFrame -> DataFrame`` function.
"""

from wrenchline.config import DEFAULT_CONFIG, EngineConfig, SeqRule

__all__ = ["DEFAULT_CONFIG", "EngineConfig", "SeqRule"]
