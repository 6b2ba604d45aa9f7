import statistics

import pytest

from tests.helpers import final_plan, plan, spend_df
from tillroll.operators import detect_recurring, top_recurring


def detect(spark, rows, **options):
    return detect_recurring(spend_df(spark, *rows), **options).first()


def months(name, amounts):
    return [(name, "X", a, f"2024-{m:02d}") for m, a in enumerate(amounts, 1)]


def test_three_equal_months_are_occasional(spark):
    row = detect(spark, months("NETFLIX", [15.49] * 3))
    assert tuple(row) == ("NETFLIX", "X", 15.49, 3, True, "OCCASIONAL", 0.0)


def test_six_equal_months_are_monthly(spark):
    assert detect(spark, months("SPOTIFY", [10.99] * 6))["recurrence_type"] == "MONTHLY"


def test_single_charge_is_irregular(spark):
    row = detect(spark, months("SHOP", [42.0]))
    assert (row["is_recurring"], row["recurrence_type"]) == (False, "IRREGULAR")
    assert row["amount_cv"] is None


def test_single_charge_is_irregular_even_if_one_month_is_enough(spark):
    row = detect(spark, months("SHOP", [42.0]), min_months=1)
    assert (row["is_recurring"], row["recurrence_type"]) == (False, "IRREGULAR")


def test_varying_amounts_do_not_recur(spark):
    assert detect(spark, months("AMAZON", [5.0, 500.0, 12.0]))["is_recurring"] is False


def test_median_is_the_lower_middle(spark):
    assert detect(spark, months("A", [1.0, 2.0, 10.0, 20.0]))["median_amount"] == 2.0


def test_many_charges_in_one_month_are_one_month(spark):
    row = detect(spark, [("A", "X", 5.0, "2024-01")] * 8)
    assert (row["occurrence_months"], row["recurrence_type"]) == (1, "IRREGULAR")


def test_missing_months_are_not_counted(spark):
    rows = [("A", "X", 5.0, None), ("A", "X", 5.0, "2024-01")]
    assert detect(spark, rows)["occurrence_months"] == 1


def test_cv_uses_rounded_values_and_is_not_rounded(spark):
    row = detect(spark, months("A", [10.0, 10.1, 10.3]))
    assert row["amount_cv"] == pytest.approx(0.15 / 10.1, abs=1e-15)


def test_thresholds(spark):
    rows = months("A", [10.0, 11.0, 12.0])
    assert detect(spark, rows)["is_recurring"] is False
    assert detect(spark, rows, amount_cv_threshold=0.2)["is_recurring"] is True
    assert detect(spark, rows, amount_cv_threshold=0.2, min_months=4)["is_recurring"] is False
    loose = detect(spark, rows, amount_cv_threshold=0.2, monthly_from=3)
    assert loose["recurrence_type"] == "MONTHLY"


def test_months_are_sorted(spark):
    rows = [("A", "X", 5.0, m) for m in ("2024-03", "2024-01", "2024-02", "2024-01")]
    assert detect(spark, rows, with_months=True)["months_seen"] == ["2024-01", "2024-02", "2024-03"]


def test_credits_are_left_out(spark):
    rows = [*months("A", [5.0, 5.0]), ("A", "X", -500.0, "2024-03", True)]
    row = detect(spark, rows)
    assert (row["median_amount"], row["occurrence_months"]) == (5.0, 2)


@pytest.mark.parametrize("parts", [1, 3, 7, 16])
def test_a_hot_merchant_has_its_exact_median_and_deviation(spark, parts):
    amount = "CAST((id * 7919) % 100003 AS DOUBLE) / 4"
    many = spark.range(0, 120_000, 1, parts).selectExpr(
        "'hot' AS description_norm", "'c' AS category", f"{amount} AS amount",
        "concat('2024-0', 1 + id % 6) AS statement_month", "false AS is_credit",
    )
    few = spend_df(spark, ("even", "c", 1.0, "2024-01"), ("even", "c", 2.0, "2024-02"), ("even", "c", 10.0, "2024-03"), ("even", "c", 20.0, "2024-03"), (None, None, -3.5, "2024-01"))
    values = sorted((i * 7919 % 100003) / 4 for i in range(120_000))
    rows = {r["description_norm"]: r for r in detect_recurring(many.unionByName(few), amount_cv_threshold=10.0).collect()}
    median = values[(len(values) + 1) // 2 - 1]
    assert rows["hot"]["median_amount"] == round(median, 2)
    assert rows["hot"]["amount_cv"] == round(statistics.stdev(values), 2) / round(median, 2)
    assert rows["even"]["median_amount"] == 2.0 and rows[None]["median_amount"] == -3.5


def test_sketches_are_an_option(spark):
    df = spend_df(spark, *[("m", "c", float(i), f"2024-0{1 + i % 3}") for i in range(9)])
    exact = detect_recurring(df).collect()
    assert detect_recurring(df, median_accuracy=10_000, approximate_months=True).collect() == exact


def test_top_takes_the_largest_and_breaks_ties(spark):
    rows = [*months("B", [5.0] * 3), *months("A", [5.0] * 3), *months("C", [9.0] * 3)]
    rows += months("D", [1.0, 99.0])
    top = top_recurring(detect_recurring(spend_df(spark, *rows)), 2).collect()
    assert [row["description_norm"] for row in top] == ["C", "A"]


def test_the_transactions_are_read_once(spark, tmp_path):
    """One scan of them makes the counted amounts; all that follows reads those, with few shuffles."""
    path = str(tmp_path / "silver")
    spend_df(spark, *[(f"M{i % 40}", "X", float(i % 7), f"2024-{i % 12 + 1:02d}") for i in range(3000)]).write.parquet(path)
    out = detect_recurring(spark.read.parquet(path))
    assert path not in plan(out) and plan(out).count("counted-amounts") == plan(out).count("Scan parquet")
    shown = final_plan(out)
    initial = shown[: shown.find("== Initial Plan ==")] if "== Initial Plan ==" in shown else shown
    assert initial.count("Exchange hashpartitioning") <= 8


def test_null_merchants_and_categories_are_groups(spark):
    rows = [(None, "X", 5.0, f"2024-{m:02d}") for m in (1, 2, 3)] + [("A", None, 7.0, f"2024-{m:02d}") for m in (1, 2)]
    rows += [(None, None, 1.0, "2024-01"), ("A", "X", None, "2024-01")]
    got = {(r[0], r[1]): (r["median_amount"], r["occurrence_months"], r["is_recurring"]) for r in detect_recurring(spend_df(spark, *rows)).collect()}
    assert got == {(None, "X"): (5.0, 3, True), ("A", None): (7.0, 2, True), (None, None): (1.0, 1, False), ("A", "X"): (None, 1, False)}
