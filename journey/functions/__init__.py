"""Scalar column expressions."""

from journey.functions.exprs import *  # noqa: F401,F403
