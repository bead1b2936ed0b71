"""All registered queries of this subpackage."""

from __future__ import annotations

from importlib import import_module

from millrace.llm.registry import ORACLES, QUERIES

for _part in ("chat", "chunking", "decontamination", "hardnegatives", "minhash", "mixing", "packing", "quality", "spelling", "suffixtree", "urlrules", "vafile", "winnowing"):
    import_module(f"millrace.llm.{_part}")

__all__ = ["ORACLES", "QUERIES"]
