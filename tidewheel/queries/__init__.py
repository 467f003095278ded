"""Every operator as a query over the given tables, with SQL that checks it."""

from __future__ import annotations

from importlib import import_module

MODULES = ["stage", "warehouse", "prep", "demand", "evaluation", "forecast", "models", "faults"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"tidewheel.queries.{name}")
