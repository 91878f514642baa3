"""Queries over the given tables, one or more per operator."""

from importlib import import_module

MODULES = ("sources", "pages", "lexical", "semantic", "results", "statistics", "signals")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
