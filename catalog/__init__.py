"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from catalog import criteria, files, full_run, relational, tables  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
