"""Registered queries, grouped as in the operator inventory."""

from importlib import import_module

MODULES = ("auditing", "features", "statistics", "preparation", "modelling", "incremental")


def load_catalog() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
