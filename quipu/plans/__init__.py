"""Registered queries over the standard tables, each next to its checking SQL."""

from importlib import import_module

from quipu.plans.catalog import QUERIES, Query

_MODULES = ("profile", "missing", "grouping", "combining", "ranking", "statistics", "landed", "language", "scalars", "containers", "matrices")


def load() -> dict[str, Query]:
    for module in _MODULES:
        import_module(f"quipu.plans.{module}")
    return QUERIES
