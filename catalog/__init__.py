"""Registered queries: each operator on the given tables, with its SQL where SQL can say it."""

from catalog.common import ORACLES, QUERIES
from catalog import reads, transforms, writes  # noqa: F401  (register their queries)

__all__ = ["ORACLES", "QUERIES"]
