"""All registered queries over the test tables, one module per group of operators."""

from __future__ import annotations

from importlib import import_module

# In reading order: each module registers its queries on import.
GROUPS = (
    "scalars",
    "sources",
    "joins",
    "aggregates",
    "sketching",
    "ordering",
    "warehouse",
    "quality",
    "statistics",
    "rules",
    "exploratory",
    "dashboards",
    "models",
)


def _registry():
    for group in GROUPS:
        import_module(f"nestmetrics.catalog.{group}")
    return import_module("nestmetrics.catalog.registry")


def queries():
    return dict(_registry().QUERIES)


def oracle_sql():
    return dict(_registry().ORACLES)
