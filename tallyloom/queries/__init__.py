"""Every operator as a query over the given tables, with the SQL that gives
the same rows."""

from importlib import import_module

from .registry import QUERIES, SQL

for _name in ("report", "merging", "profiling", "converting", "documents", "checking", "presenting", "storing"):
    import_module(f"{__name__}.{_name}")

__all__ = ["QUERIES", "SQL"]
