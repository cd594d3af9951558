"""Every query of the harmonisation operators with its oracle."""

from __future__ import annotations

from concordat.queries import harness, linking, mapping, profiling, proposing, stages  # noqa: F401  they register themselves
from concordat.queries.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
