"""Registered queries over the given tables, each with its SQL counterpart."""

from workload import (  # noqa: F401  (importing registers the queries)
    enrich_queries,
    gate_queries,
    model_queries,
    source_queries,
    tick_queries,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
