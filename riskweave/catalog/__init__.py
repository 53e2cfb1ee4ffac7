"""Every operator as a query over the given tables, next to the SQL it must equal."""

from riskweave.catalog import features, inputs, orders, outputs, stream, training  # noqa: F401
from riskweave.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
