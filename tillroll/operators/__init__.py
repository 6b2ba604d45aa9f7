"""Operators: functions from DataFrames to DataFrames, and the writers built on them."""

from tillroll.operators.charges import add_ingest_metadata, only_charges
from tillroll.operators.compact import Compaction, compact_table, file_sizes
from tillroll.operators.key_history import KeyHistory
from tillroll.operators.merge import drop_known_rows, insert_only_merge, rows_absent_from
from tillroll.operators.normalize import normalize_statements
from tillroll.operators.quality import QualityError, QualityResult, quality_report, run_quality
from tillroll.operators.recurring import detect_recurring
from tillroll.operators.reports import month_slice, source_files, top_recurring
from tillroll.operators.rule_join import categorize_by_table, match_rules
from tillroll.operators.spend import (
    fixed_vs_variable,
    month_category_totals,
    monthly_by_category,
    without_credits,
)

__all__ = [
    "Compaction",
    "KeyHistory",
    "QualityError",
    "QualityResult",
    "add_ingest_metadata",
    "categorize_by_table",
    "compact_table",
    "detect_recurring",
    "drop_known_rows",
    "file_sizes",
    "fixed_vs_variable",
    "insert_only_merge",
    "match_rules",
    "month_category_totals",
    "month_slice",
    "monthly_by_category",
    "normalize_statements",
    "only_charges",
    "quality_report",
    "rows_absent_from",
    "run_quality",
    "source_files",
    "top_recurring",
    "without_credits",
]
