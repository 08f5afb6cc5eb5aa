"""Registered queries over the given tables, each with its SQL counterpart.

Modules register with :func:`base.query`; importing this package loads all.
"""

from . import (  # noqa: F401
    academic_queries, clean_queries, dim_queries, dedup_queries, join_queries, load_queries,
    ragged_queries, rule_queries, source_queries,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
