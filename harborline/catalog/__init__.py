"""Registered queries, each with the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "kpis", "validation", "cleaning", "analytics", "decomposition",
    "evidence", "measures", "scalars", "relational",
    "storage",
)


def load() -> None:
    """Import every module so that its queries register."""
    for name in MODULES:
        import_module(f"harborline.catalog.{name}")
