"""Whole jobs, from files to published tables."""

from tillroll.plans.gold import refresh_counts, refresh_gold
from tillroll.plans.paths import StatementPaths
from tillroll.plans.rejects import Rejects
from tillroll.plans.statements import bronze_rows, build_gold, build_silver, ingest_statements

__all__ = [
    "Rejects",
    "StatementPaths",
    "bronze_rows",
    "build_gold",
    "build_silver",
    "ingest_statements",
    "refresh_counts",
    "refresh_gold",
]
