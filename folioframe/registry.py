"""All queries of the engine itself, with their SQL."""

from __future__ import annotations

from .plans import exchange, fulltext  # noqa: F401  their queries register themselves
from .plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
