"""Category vocabulary, categorisation rules and quality rules, kept as data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import RULE_TABLE_SCHEMA

# ---------------------------------------------------------------------------
# The category labels and the default rules. Results depend on
# them, and on the order of the keyword rules, so they are stated as they are.
# ---------------------------------------------------------------------------

CATEGORIES = [
    "Groceries", "Food & Drink", "Shopping", "Gas", "Health", "Travel", "Entertainment",
    "Subscriptions", "Bills & Utilities", "Personal Care", "Home", "Transfer", "Uncategorized",
]

UNCATEGORIZED = "Uncategorized"

SOURCE_CATEGORY_MAP = {
    "Food & Drink": "Food & Drink",
    "Groceries": "Groceries",
    "Gas": "Gas",
    "Travel": "Travel",
    "Entertainment": "Entertainment",
    "Health & Wellness": "Health",
    "Shopping": "Shopping",
    "Bills & Utilities": "Bills & Utilities",
    "Professional Services": "Bills & Utilities",
    "Fees & Adjustments": "Bills & Utilities",
    "Personal": "Personal Care",
}

KEYWORD_RULES = [
    ("TRADER JOE", "Groceries"),
    ("WHOLE FOODS", "Groceries"),
    ("SAFEWAY", "Groceries"),
    ("BUTCHERBOX", "Groceries"),
    ("UBER EATS", "Food & Drink"),
    ("DOORDASH", "Food & Drink"),
    ("GRUBHUB", "Food & Drink"),
    ("STARBUCKS", "Food & Drink"),
    ("UBER TRIP", "Travel"),
    ("HOLIDAY INN", "Travel"),
    ("CHEVRON", "Gas"),
    ("SHELL", "Gas"),
    ("ARCO", "Gas"),
    ("ZOOMCARE", "Health"),
    ("CVS", "Health"),
    ("WALGREENS", "Health"),
    ("PHARMACY", "Health"),
    ("GYM", "Health"),
    ("PLANET FITNESS", "Health"),
    ("NETFLIX", "Subscriptions"),
    ("SPOTIFY", "Subscriptions"),
    ("HULU", "Subscriptions"),
    ("AMAZON PRIME", "Subscriptions"),
    ("APPLE.COM", "Subscriptions"),
    ("GOOGLE ONE", "Subscriptions"),
    ("AMAZON", "Shopping"),
    ("VENMO", "Transfer"),
    ("ZELLE", "Transfer"),
    ("PAYPAL", "Transfer"),
    ("GEICO", "Bills & Utilities"),
    ("PLAN FEE", "Bills & Utilities"),
]

SEED_RULES = [
    ("TRADER JOE", "Groceries"),
    ("WHOLE FOODS", "Groceries"),
    ("AMAZON", "Shopping"),
    ("NETFLIX", "Subscriptions"),
    ("SPOTIFY", "Subscriptions"),
    ("APPLE.COM", "Subscriptions"),
    ("UBER EATS", "Food & Drink"),
    ("DOORDASH", "Food & Drink"),
    ("STARBUCKS", "Food & Drink"),
    ("CHEVRON", "Gas"),
    ("SHELL", "Gas"),
    ("ARCO", "Gas"),
    ("WALGREENS", "Health"),
    ("CVS", "Health"),
    ("PLANET FITNESS", "Health"),
    ("VENMO", "Transfer"),
    ("ZELLE", "Transfer"),
    ("PAYPAL", "Transfer"),
]

# ---------------------------------------------------------------------------


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]] = SEED_RULES) -> DataFrame:
    """An ordered rule list as a ``(priority, keyword, category)`` table, first rule first."""
    rows = [(i, keyword, category) for i, (keyword, category) in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_TABLE_SCHEMA)


@dataclass(frozen=True)
class QualityRule:
    """A named SQL predicate that valid rows satisfy."""

    name: str
    condition: str
    severity: Literal["ERROR", "WARN"]

    def __post_init__(self) -> None:
        if self.severity not in ("ERROR", "WARN"):
            raise ValueError(f"severity must be ERROR or WARN, not {self.severity!r}")


def _sql_strings(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def silver_quality_rules(
    categories: Sequence[str] = CATEGORIES, today: date | None = None
) -> list[QualityRule]:
    """The default rules of the silver table.

    ``today`` pins the reference day of the future-date rule, which otherwise is the day the
    query runs, so that a report over historic data can be repeated.
    """
    day = "current_date()" if today is None else f"DATE'{today.isoformat()}'"
    # Rule names, limits and severities appear in the quality log.
    return [
        QualityRule("no_null_trans_date", "trans_date IS NOT NULL", "ERROR"),
        QualityRule("positive_amount", "amount > 0", "ERROR"),
        QualityRule("valid_stmt_month", "statement_month RLIKE '^[0-9]{4}-[0-9]{2}$'", "ERROR"),
        QualityRule("no_null_description", "description IS NOT NULL", "ERROR"),
        QualityRule("known_category", f"category IN ({_sql_strings(categories)})", "WARN"),
        QualityRule("no_future_dates", f"trans_date <= {day}", "WARN"),
        QualityRule("reasonable_amount", "amount < 50000", "WARN"),
    ]
