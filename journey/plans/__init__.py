"""Registered queries over the benchmark tables, their oracle SQL, plan checks."""

from journey.plans.catalog import FLAGSHIP, QUERIES
from journey.plans.oracle import ORACLE_SQL

__all__ = ["FLAGSHIP", "QUERIES", "ORACLE_SQL"]
