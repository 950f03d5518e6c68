"""Conversion-funnel analytics as Spark DataFrame operators.

Every operator is a plain function ``(DataFrames..., params) -> DataFrame``
written with built-in Spark expressions, so Catalyst sees one declarative
plan per query (pushdown, pruning, partial aggregation, AQE).
"""

from journey.spec import FunnelSpec, Roles, PRESETS
from journey.session import get_spark

__all__ = ["FunnelSpec", "Roles", "PRESETS", "get_spark"]
