from datetime import date

import pytest

from tests.helpers import plan, rows_of
from tillroll.operators import QualityError, quality_report, run_quality
from tillroll.rules import QualityRule, silver_quality_rules
from tillroll.schemas import QUALITY_LOG_SCHEMA, QUALITY_REPORT_SCHEMA

SCHEMA = "trans_date date, amount double, statement_month string, description string, category string"
GOOD = (date(2024, 1, 5), 5.0, "2024-01", "SHOP", "Groceries")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def failures(df, *args, **options):
    return {r["rule_name"]: r["failed_rows"] for r in quality_report(df, *args, **options).collect()}


def test_default_rules(spark):
    bad = (date(2999, 1, 1), 60000.0, "Jan", None, "Nonsense")
    worse = (None, -1.0, None, "SHOP", None)
    got = failures(frame(spark, GOOD, bad, worse))
    assert got == {
        "no_null_trans_date": 1,
        "positive_amount": 1,
        "valid_stmt_month": 1,
        "no_null_description": 1,
        "known_category": 1,
        "no_future_dates": 1,
        "reasonable_amount": 1,
    }


def test_null_verdicts_pass_unless_strict(spark):
    df = frame(spark, GOOD, (None, None, None, "SHOP", None))
    assert failures(df)["positive_amount"] == 0
    strict = failures(df, null_is_failure=True)
    assert strict["positive_amount"] == strict["known_category"] == strict["valid_stmt_month"] == 1


def test_report_rows(spark):
    rules = [QualityRule("small", "amount < 10", "WARN"), QualityRule("id", "amount > 0", "ERROR")]
    rows = [GOOD, GOOD, (date(2024, 1, 5), 70.0, "2024-01", "SHOP", "Gas")]
    report = quality_report(frame(spark, *rows), rules)
    assert rows_of(report) == [("id", "ERROR", 3, 0, 0.0), ("small", "WARN", 3, 1, 33.33)]


def test_empty_input_keeps_the_schema(spark):
    report = quality_report(frame(spark))
    assert report.schema.simpleString() == QUALITY_REPORT_SCHEMA.simpleString()
    assert {r["failure_pct"] for r in report.collect()} == {0.0}


def test_no_rules_means_no_rules(spark):
    assert quality_report(frame(spark, GOOD), []).count() == 0


def test_reference_day_can_be_pinned(spark):
    assert failures(frame(spark, GOOD), silver_quality_rules(today=date(2024, 1, 4)))["no_future_dates"] == 1


def test_labels_with_quotes(spark):
    rules = silver_quality_rules(["Mom's \\ Pop's"])
    df = frame(spark, (date(2024, 1, 5), 5.0, "2024-01", "SHOP", "Mom's \\ Pop's"))
    assert failures(df, rules)["known_category"] == 0


def test_severity_is_checked():
    with pytest.raises(ValueError):
        QualityRule("x", "true", "FATAL")


def test_all_rules_in_one_pass(spark, tmp_path):
    frame(spark, GOOD).write.parquet(str(tmp_path / "t"))
    text = plan(quality_report(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("Scan") == 1
    assert text.count("Exchange") == 1


def test_run_logs_then_raises(spark, tmp_path):
    log = str(tmp_path / "log")
    ok = run_quality(spark, frame(spark, GOOD), log)
    assert [r.failed_rows for r in ok] == [0] * 7
    with pytest.raises(QualityError, match="positive_amount") as error:
        run_quality(spark, frame(spark, (date(2024, 1, 5), -5.0, "2024-01", "SHOP", "Gas")), log)
    assert error.value.failed == ["positive_amount"]
    assert isinstance(error.value, ValueError)
    logged = spark.read.parquet(log)
    assert logged.count() == 14
    assert logged.schema.simpleString() == QUALITY_LOG_SCHEMA.simpleString()
    assert logged.where("checked_at IS NULL").count() == 0


def test_warnings_do_not_raise(spark, tmp_path):
    rows = frame(spark, (date(2024, 1, 5), 5.0, "2024-01", "SHOP", "Nonsense"))
    results = run_quality(spark, rows, str(tmp_path / "log"))
    assert sum(r.failed_rows for r in results) == 1
