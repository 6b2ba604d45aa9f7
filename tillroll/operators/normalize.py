"""Typed, normalised and categorised transactions from raw statement rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.category import categorize
from tillroll.functions.dates import (
    STATEMENT_CUT_DAY,
    STATEMENT_DATE_FORMAT,
    parse_statement_date,
    statement_month,
)
from tillroll.functions.text import normalize_text
from tillroll.rules import KEYWORD_RULES, SOURCE_CATEGORY_MAP
from tillroll.schemas import RAW_COLUMNS


def normalize_statements(
    bronze: DataFrame,
    *,
    rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
    mapping: Mapping[str, str] = SOURCE_CATEGORY_MAP,
    cut_day: int = STATEMENT_CUT_DAY,
    date_format: str = STATEMENT_DATE_FORMAT,
    normalize_keywords: bool = True,
) -> DataFrame:
    """Rename, parse the dates, flip the sign, normalise the text, categorise, bucket by month.

    Columns other than the raw ones are carried along. Dates that do not parse become NULL, and
    the quality rules report them. No shuffle and no Python: one projection per input row.
    """
    carried = [F.col(f"`{name}`") for name in bronze.columns if name not in RAW_COLUMNS]
    typed = bronze.select(
        F.col("Description").alias("description"),
        F.col("Category").alias("chase_category"),
        F.col("Type").alias("transaction_type"),
        F.col("Memo").alias("memo"),
        *carried,
        parse_statement_date(F.col("Transaction Date"), date_format).alias("trans_date"),
        parse_statement_date(F.col("Post Date"), date_format).alias("post_date"),
        (-F.col("Amount")).cast("double").alias("amount"),
        normalize_text(F.col("Description")).alias("description_norm"),
    )
    category = categorize(
        F.col("description_norm"),
        F.col("chase_category"),
        rules,
        mapping,
        normalize_keywords=normalize_keywords,
    )
    return typed.select(
        "*",
        category.alias("category"),
        statement_month(F.col("trans_date"), cut_day).alias("statement_month"),
        (F.col("amount") < 0).alias("is_credit"),
        F.current_timestamp().alias("_silver_ts"),
    )
