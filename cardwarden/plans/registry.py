"""All catalogue modules loaded."""

from __future__ import annotations

from cardwarden.plans import modelling, monitoring, properties, reports, scoring, streams, tables  # noqa: F401
from cardwarden.plans.catalog import ORACLES, QUERIES

# Queries that read a fitted model; they take longest and come last.
MODEL_QUERIES = {n: q for n, q in QUERIES.items() if q.__module__ in (modelling.__name__, properties.__name__)}
QUICK_QUERIES = {n: q for n, q in QUERIES.items() if n not in MODEL_QUERIES}

__all__ = ["MODEL_QUERIES", "ORACLES", "QUERIES", "QUICK_QUERIES"]
