"""Every operator as a query over the given tables, and the same query as plain SQL."""

from .oracle import ORACLE
from .registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]
