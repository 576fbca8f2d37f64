"""DuckDB statements that answer the registered queries independently of Spark."""

from oracles.statements import ORACLES

__all__ = ["ORACLES"]
