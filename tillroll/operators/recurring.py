"""Merchants that charge the same amount again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import ratio_if_positive
from tillroll.operators.spend import without_credits
from tillroll.sources.scratch import staged_table

# A recurring charge is seen in this many months or more, with amounts that vary
# less than this; one seen in this many months counts as monthly.
MIN_MONTHS = 2
AMOUNT_CV_BELOW = 0.05
MONTHLY_FROM = 6
# Amounts are told apart to this part of a unit.
AMOUNT_SCALE = 10_000
_KEYS = ["description_norm", "category"]


def _who() -> Column:
    """Merchant and category as one value, which equals itself in a join where a part is NULL."""
    return F.struct(*_KEYS).alias("who")


def counted_amounts(silver: DataFrame) -> DataFrame:
    """How often each merchant charged each amount in each month.

    A plain hash aggregate, reduced before its shuffle; all that follows works on its rows, and a
    merchant with very many equal charges has few of them.
    """
    return without_credits(silver).groupBy(*_KEYS, "statement_month", "amount").agg(
        F.count(F.lit(1)).alias("n")
    )


def exact_medians(amounts: DataFrame) -> DataFrame:
    """The lower median per ``who`` of ``amount`` counted by ``n``; NULLs aside.

    First the whole unit of amount that holds the middle charge is found from counts per unit, then
    the middle among the amounts of that unit only. No task sees all amounts of a merchant, and the
    amounts are shuffled once, by merchant and unit: a merchant has one such unit, so that the windows
    over it need no other shuffle. ``amounts`` is read twice.
    """
    known = amounts.where(F.col("amount").isNotNull()).withColumn("unit", F.floor("amount"))
    units = known.groupBy("who", "unit").agg(F.sum("n").alias("in_unit"))
    by_unit = Window.partitionBy("who").orderBy("unit")
    middle = F.expr("(total + 1) div 2")
    holding = (
        units.withColumn("up_to", F.sum("in_unit").over(by_unit))
        .withColumn("total", F.sum("in_unit").over(Window.partitionBy("who")))
        .where((F.col("up_to") >= middle) & (F.col("up_to") - F.col("in_unit") < middle))
        .select("who", "unit", (middle - F.col("up_to") + F.col("in_unit")).alias("rank"))
    )
    # Equal amounts of several months are peers in this order, and all counted at once.
    by_amount = Window.partitionBy("who", "unit").orderBy("amount")
    return (
        known.join(holding, ["who", "unit"])
        .withColumn("up_to", F.sum("n").over(by_amount))
        .where(F.col("up_to") >= F.col("rank"))
        .groupBy("who", "unit")
        .agg(F.min("amount").alias("median"))
        .drop("unit")
    )


def _deviation() -> Column:
    """Sample standard deviation from exact moments of the counted amounts."""
    scaled = F.round(F.col("amount") * AMOUNT_SCALE).try_cast("decimal(19,0)")
    n = F.sum(F.when(F.col("amount").isNotNull(), F.col("n")))
    total = F.sum(scaled * F.col("n")).cast("double")
    squares = F.sum((scaled * scaled).cast("decimal(38,0)") * F.col("n").cast("decimal(10,0)")).cast("double")
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)) / AMOUNT_SCALE)


def detect_recurring(
    silver: DataFrame,
    *,
    min_months: int = MIN_MONTHS,
    amount_cv_threshold: float = AMOUNT_CV_BELOW,
    monthly_from: int = MONTHLY_FROM,
    median_accuracy: int | None = None,
    approximate_months: bool = False,
    with_months: bool = False,
    amounts: DataFrame | None = None,
) -> DataFrame:
    """Per merchant and category: median amount, months seen, and whether the charge recurs.

    The transactions are read once, to the small table of :func:`counted_amounts`, which is staged;
    pass ``amounts`` where it is staged already.

    The median is the lower of the two middle amounts where there are two. It is exact; with
    ``median_accuracy`` it is a sketch whose rank is off by at most one part in so many, which
    saves a join. ``approximate_months`` estimates the number of months. The coefficient of
    variation is of the rounded values. A merchant without one (a single charge, or a median that is
    not positive) does not recur. ``with_months`` adds the sorted months.
    """
    cv = ratio_if_positive(F.col("amount_stddev"), F.col("median_amount"))
    recurs = (F.col("occurrence_months") >= min_months) & (
        F.col("amount_cv") < amount_cv_threshold
    )
    kind = (
        F.when(~F.col("is_recurring"), "IRREGULAR")
        .when(F.col("occurrence_months") >= monthly_from, "MONTHLY")
        .otherwise("OCCASIONAL")
    )
    amounts = amounts if amounts is not None else staged_table(counted_amounts(silver), "counted-amounts")
    amounts = amounts.select(_who(), "statement_month", "amount", "n")
    # A merchant has few months, so that a set of them is small and needs no shuffle of its own.
    seen = F.collect_set("statement_month")
    n_months = F.approx_count_distinct("statement_month") if approximate_months else F.size(seen).cast("long")
    if median_accuracy is not None:
        sketch = F.percentile_approx("amount", 0.5, median_accuracy)
        medians = without_credits(silver).groupBy(_who()).agg(sketch.alias("median"))
    else:
        medians = exact_medians(amounts)
    months = F.array_sort(seen).alias("months_seen")
    found = amounts.groupBy("who").agg(
        n_months.alias("occurrence_months"),
        F.round(_deviation(), 2).alias("amount_stddev"),
        *([months] if with_months else []),
    )
    return (
        found.join(medians, "who", "left")
        .withColumn("median_amount", F.round("median", 2))
        .withColumn("amount_cv", cv)
        .withColumn("is_recurring", F.coalesce(recurs, F.lit(False)))
        .select(
            "who.*",
            "median_amount",
            "occurrence_months",
            "is_recurring",
            kind.alias("recurrence_type"),
            "amount_cv",
            *(["months_seen"] if with_months else []),
        )
    )
