from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows_of, spend_df
from tillroll.operators import fixed_vs_variable, monthly_by_category


def monthly(spark, *rows):
    result = monthly_by_category(spend_df(spark, *rows)).collect()
    return {(r["statement_month"], r["category"]): r for r in result}


def test_columns(spark):
    assert monthly_by_category(spend_df(spark)).columns == [
        "statement_month", "category", "total_spend", "tx_count", "avg_tx", "pct_of_month",
        "mom_delta",
    ]


def test_totals_shares_and_changes(spark):
    got = monthly(
        spark,
        ("A", "Food", 10.0, "2024-01"),
        ("A", "Food", 20.0, "2024-01"),
        ("B", "Gas", 10.0, "2024-01"),
        ("A", "Food", 45.5, "2024-02"),
    )
    assert tuple(got["2024-01", "Food"])[2:] == (30.0, 2, 15.0, 75.0, None)
    assert tuple(got["2024-01", "Gas"])[2:] == (10.0, 1, 10.0, 25.0, None)
    assert tuple(got["2024-02", "Food"])[2:] == (45.5, 1, 45.5, 100.0, 15.5)


def test_change_skips_months_without_spend(spark):
    got = monthly(spark, ("A", "Food", 10.0, "2024-01"), ("A", "Food", 25.0, "2024-03"))
    assert got["2024-03", "Food"]["mom_delta"] == 15.0


def test_credits_and_unknown_flags_are_left_out(spark):
    got = monthly(
        spark,
        ("A", "Food", 5.0, "2024-01", False),
        ("A", "Food", -10.0, "2024-01", True),
        ("A", "Food", None, "2024-01", None),
    )
    assert len(got) == 1
    assert tuple(got["2024-01", "Food"])[2:5] == (5.0, 1, 5.0)


def test_rows_without_a_month_do_not_show_and_do_not_count(spark):
    got = monthly(spark, ("A", "Food", 99.0, None), ("A", "Food", 5.0, "2024-01"))
    assert list(got) == [("2024-01", "Food")]
    assert got["2024-01", "Food"]["mom_delta"] is None


def test_month_total_of_zero_has_no_share(spark):
    got = monthly(spark, ("A", "Food", 5.0, "2024-01"), ("A", "Gas", -5.0, "2024-01", False))
    assert got["2024-01", "Food"]["pct_of_month"] is None


def test_null_category_is_a_group(spark):
    got = monthly(spark, ("A", None, 5.0, "2024-01"), ("A", None, 6.0, "2024-02"))
    assert got["2024-02", None]["mom_delta"] == 1.0


def test_mean_does_not_depend_on_the_order_of_the_sum(spark):
    amounts = [0.1, 0.2, 0.3, 1e8, 4.43, -1e8]
    means = set()
    for order in (amounts, amounts[::-1], sorted(amounts)):
        rows = [("A", "Food", a, "2024-01", False) for a in order]
        means.add(monthly_by_category(spend_df(spark, *rows).coalesce(1)).first()["avg_tx"])
    assert means == {0.84}


def test_no_join_and_one_scan(spark, tmp_path):
    spend_df(spark, ("A", "Food", 1.0, "2024-01")).write.parquet(str(tmp_path / "s"))
    text = plan(monthly_by_category(spark.read.parquet(str(tmp_path / "s"))))
    assert "Join" not in text
    assert text.count("Scan") == 1
    assert "description_norm" not in text


@pytest.mark.parametrize(
    ("amounts", "label"),
    [
        ([15.49] * 6, "FIXED"),
        ([100.0, 130.0, 80.0], "VARIABLE"),
        ([10.0, 200.0, 5.0], "DISCRETIONARY"),
        ([42.0], "DISCRETIONARY"),
        ([0.0, 0.0], "DISCRETIONARY"),
    ],
)
def test_stability(spark, amounts, label):
    rows = [("A", "X", a, f"2024-{m:02d}") for m, a in enumerate(amounts, 1)]
    row = fixed_vs_variable(spend_df(spark, *rows)).first()
    assert row["classification"] == label
    assert row["sample_months"] == len(amounts)


def test_stability_values_and_thresholds(spark):
    df = spend_df(spark, ("A", "X", 10.0, "2024-01"), ("B", "X", 2.0, "2024-01"), ("A", "X", 6.0, "2024-02"))
    row = fixed_vs_variable(df).first()
    assert tuple(row) == ("X", 9.0, 4.24, 2, 0.471, "VARIABLE")
    assert fixed_vs_variable(df, fixed_below=0.48).first()["classification"] == "FIXED"
    strict = fixed_vs_variable(df, fixed_below=0.1, variable_below=0.2)
    assert strict.first()["classification"] == "DISCRETIONARY"


def test_spend_adds_up(spark):
    rows = [(f"M{i % 7}", f"C{i % 3}", round(i * 1.37, 2), f"2024-{i % 5 + 1:02d}") for i in range(200)]
    df = spend_df(spark, *rows)
    total = monthly_by_category(df).agg(F.sum("total_spend"), F.sum("tx_count")).first()
    assert total[0] == pytest.approx(sum(r[2] for r in rows))
    assert total[1] == 200
    shares = monthly_by_category(df).groupBy("statement_month").agg(F.sum("pct_of_month"))
    assert all(abs(share - 100) < 0.2 for _, share in rows_of(shares))


@pytest.mark.parametrize("parts", [1, 3, 7, 16])
def test_large_totals_are_exact(spark, parts):
    """Totals above 1e12, whose cents a sum of doubles would lose with the order of rows."""
    rows = spark.range(0, 300_000, 1, parts).selectExpr(
        "'2024-01' AS statement_month", "'c' AS category",
        "CAST((id * 104729) % 1200000007 AS DOUBLE) * 10 + (id % 100) / 100D AS amount",
        "'m' AS description_norm", "false AS is_credit",
    )
    exact = sum(Decimal((i * 104729) % 1200000007) * 10 + Decimal(i % 100) / 100 for i in range(300_000))
    row = monthly_by_category(rows).first()
    assert exact > 10**12
    assert row["total_spend"] == float(exact)


def test_totals_from_counted_amounts_are_those_of_the_transactions(spark):
    from tillroll.operators.recurring import counted_amounts
    from tillroll.operators.spend import month_category_totals, totals_from_amounts

    rows = [(f"M{i % 5}", ["X", "Y", None][i % 3], [0.1, 2.35, None, -4.0, float("nan")][i % 5], f"2024-{i % 4 + 1:02d}", i % 11 == 0) for i in range(400)]
    silver = spend_df(spark, *rows)
    assert rows_of(totals_from_amounts(counted_amounts(silver))) == rows_of(month_category_totals(silver))
    assert totals_from_amounts(counted_amounts(spend_df(spark, *rows[:0]))).count() == 0
