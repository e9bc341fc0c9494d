"""Queries over the driver tables."""

from __future__ import annotations

import importlib

MODULES = ("scalar_queries", "relational_queries", "retrieval_queries", "page_queries",
           "source_queries", "task_queries")


def load() -> tuple[dict, dict]:
    """All registered queries and their SQL twins."""
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
    from workload.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
