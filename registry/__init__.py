"""Every operator as a query over the given tables, next to the SQL that checks it."""

from importlib import import_module

from registry.core import ORACLES, QUERIES

for _m in ("sources", "validation", "profiling", "exploring", "splitting", "preparing", "featuring", "sampling", "lookups",
           "scoring", "modelling", "reporting"):
    import_module(f"registry.{_m}")

__all__ = ["ORACLES", "QUERIES"]
