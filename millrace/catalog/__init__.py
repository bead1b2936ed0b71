"""Registered queries over the supplied tables, each with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

from millrace.catalog.registry import ORACLES, QUERIES

for _part in ("scans", "rowwise", "joining", "grouping", "ordering", "scalars", "jobs", "streams", "stateful", "increments", "ranges", "workflow", "outputs"):
    import_module(f"millrace.catalog.{_part}")

__all__ = ["ORACLES", "QUERIES"]
