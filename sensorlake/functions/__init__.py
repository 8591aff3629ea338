"""Scalar column expressions (JVM-side built-ins only)."""

from sensorlake.functions.columns import *  # noqa: F401,F403
