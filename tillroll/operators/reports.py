"""Small reports over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_files(bronze: DataFrame) -> DataFrame:
    """The files that rows came from."""
    return bronze.select("_source_file").distinct()


def top_recurring(recurring: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` recurring charges by median amount; ties go by merchant and category.

    A sort with a limit keeps ``n`` rows per task and merges those.
    """
    return (
        recurring.where("is_recurring")
        .orderBy(F.desc("median_amount"), "description_norm", "category")
        .limit(n)
    )


def month_slice(silver: DataFrame, month: str, category: str | None = None) -> DataFrame:
    """Transactions of one statement month. Other months' directories are not read."""
    rows = silver.where(F.col("statement_month") == month)
    return rows if category is None else rows.where(F.col("category") == category)
