"""Scalar column expressions; all built-in, so they stay in generated JVM code."""
