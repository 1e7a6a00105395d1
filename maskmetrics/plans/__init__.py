"""Dashboards, facts and the registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("metric_queries", "report_queries", "shape_queries", "alias_queries", "catalog_queries",
           "pii_queries", "name_queries", "broken_name_queries", "claim_queries", "stream_queries")


def load_queries() -> tuple[dict, dict]:
    """All queries and their SQL, by name."""
    for module in MODULES:
        import_module(f"maskmetrics.plans.{module}")
    from maskmetrics.plans.registered import ORACLES, QUERIES
    return QUERIES, ORACLES
