"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from retailgrain.checks import aggregates, columns, joins, reports, scalars, sources, streams, windows, yoy
from retailgrain.checks.registry import CHECKS

__all__ = ["CHECKS", "aggregates", "columns", "joins", "reports", "scalars", "sources", "streams", "windows", "yoy"]
