"""All runnable queries over the supplied tables."""

from importlib import import_module

from .base import ORACLES, QUERIES

for _part in ("relational", "summaries", "scalars", "semantics", "files", "streams", "marts"):
    import_module(f"{__name__}.{_part}")

__all__ = ["ORACLES", "QUERIES"]
