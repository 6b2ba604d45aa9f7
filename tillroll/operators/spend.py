"""Spend per month and category, and how steady it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import label_below, percent_of, ratio_if_positive

# Below these coefficients of variation a category is fixed, or variable.
FIXED_BELOW = 0.15
VARIABLE_BELOW = 0.50


# Amounts are summed as decimals with so many digits and decimals: exactly, so that neither the order
# in which tasks finish nor the size of a total decides a rounding between two cents.
SUM_TYPE = "decimal(24,6)"


def exact_sum(amount: str) -> Column:
    """The exact sum of an amount as a double; what is no finite number counts as NULL."""
    return F.sum(F.col(amount).try_cast(SUM_TYPE)).cast("double")


def exact_mean(amount: str) -> Column:
    """The mean of an amount, from :func:`exact_sum`; NULL where there is no amount."""
    return F.try_divide(exact_sum(amount), F.count(amount))


def sorted_deviation(values: Column) -> Column:
    """Sample standard deviation of an array, taken in the order of its values.

    The order makes the result the same in every run. NULL for fewer than two values.
    """
    n = F.size(values)
    ordered = F.sort_array(values)
    mean = F.aggregate(ordered, F.lit(0.0), lambda total, x: total + x) / n
    squares = F.aggregate(ordered, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def without_credits(silver: DataFrame) -> DataFrame:
    """Rows that are known not to be credits; rows with a NULL flag go too."""
    return silver.where(~F.col("is_credit"))


def month_category_totals(silver: DataFrame) -> DataFrame:
    """Sum and count of spend per statement month and category.

    The only step of this module that sees transactions, and all that the others need: rows are
    summed up before they are shuffled, and the result has months × categories rows.
    """
    return (
        without_credits(silver)
        .groupBy("statement_month", "category")
        .agg(
            exact_sum("amount").alias("spend"),
            F.count(F.lit(1)).alias("tx_count"),
            exact_mean("amount").alias("mean"),
        )
    )


def totals_from_amounts(amounts: DataFrame) -> DataFrame:
    """:func:`month_category_totals` from amounts that are counted (``n``) per month and category."""
    n = F.col("n").cast("decimal(10,0)")
    spend = F.sum(F.col("amount").try_cast(SUM_TYPE) * n).cast("double")
    known = F.sum(F.when(F.col("amount").isNotNull(), F.col("n")))
    return amounts.groupBy("statement_month", "category").agg(
        spend.alias("spend"), F.sum("n").alias("tx_count"), F.try_divide(spend, known).alias("mean")
    )


def monthly_from_totals(totals: DataFrame) -> DataFrame:
    """:func:`monthly_by_category` from the totals.

    Rows without a month come last in the order of the months and are dropped at the end. Dropped
    first, the condition would move down to the transactions, where a month that is computed
    rather than stored would be computed once more for it.
    """
    of_month = Window.partitionBy("statement_month")
    by_month = Window.partitionBy("category").orderBy(F.asc_nulls_last("statement_month"))
    spend = F.col("total_spend")
    rounded = totals.select(
        "statement_month",
        "category",
        F.round("spend", 2).alias("total_spend"),
        "tx_count",
        F.round("mean", 2).alias("avg_tx"),
    )
    return rounded.select(
        "*",
        F.round(percent_of(spend, F.sum(spend).over(of_month)), 1).alias("pct_of_month"),
        F.round(spend - F.lag(spend).over(by_month), 2).alias("mom_delta"),
    ).where(F.col("statement_month").isNotNull())


def stability_from_totals(
    totals: DataFrame, *, fixed_below: float = FIXED_BELOW, variable_below: float = VARIABLE_BELOW
) -> DataFrame:
    """:func:`fixed_vs_variable` from the totals."""
    cv = F.round(ratio_if_positive(F.col("stddev_monthly"), F.col("avg_monthly")), 3)
    steps = [(fixed_below, "FIXED"), (variable_below, "VARIABLE")]
    return (
        totals.groupBy("category")
        .agg(
            F.round(exact_mean("spend"), 2).alias("avg_monthly"),
            # one value per month and category, so the array is short
            F.round(sorted_deviation(F.collect_list("spend")), 2).alias("stddev_monthly"),
            F.count(F.lit(1)).alias("sample_months"),
        )
        .withColumn("cv", cv)
        .withColumn("classification", label_below(F.col("cv"), steps, "DISCRETIONARY"))
    )


def monthly_by_category(silver: DataFrame) -> DataFrame:
    """Spend, count and mean per month and category, share of the month, change over the month.

    The share is of the sum of the *rounded* totals. The change is against the previous month in
    which the category occurs, and NULL in its first. Rows without a month are left out.

    The total of a month is a window over the small aggregate instead of a join back to it.
    """
    return monthly_from_totals(month_category_totals(silver))


def fixed_vs_variable(
    silver: DataFrame, *, fixed_below: float = FIXED_BELOW, variable_below: float = VARIABLE_BELOW
) -> DataFrame:
    """Class of each category by the coefficient of variation of its monthly spend.

    Months without spend are absent, not zero. A category seen in one month has no deviation and
    counts as discretionary.
    """
    return stability_from_totals(
        month_category_totals(silver), fixed_below=fixed_below, variable_below=variable_below
    )
