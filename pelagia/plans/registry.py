"""Every query of the library by name, with its SQL."""

from __future__ import annotations

from pelagia.plans import analysis, catalogue, stores, tabular  # noqa: F401  they register their queries
from pelagia.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
