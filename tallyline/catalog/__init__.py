"""Registered queries: each pairs a Spark plan with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from tallyline.catalog.registry import ORACLES, QUERIES

MODULES = [
    "projection", "joining", "aggregation", "scalars", "files",
    "close", "pnl", "bridge", "daily", "fx", "hierarchy", "reconcile", "growth", "people", "ops",
]

for _module in MODULES:
    import_module(f"tallyline.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
