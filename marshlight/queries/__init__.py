"""Registered queries: each runs a library function over the given tables, most with a SQL equivalent."""

from . import checks_agg, checks_climate, checks_formatting, checks_join, checks_plans, checks_source, checks_window
from .registry import QUERIES, oracle_sql

__all__ = ["QUERIES", "checks_agg", "checks_climate", "checks_formatting", "checks_join", "checks_plans",
           "checks_source", "checks_window", "oracle_sql"]
