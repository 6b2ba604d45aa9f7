from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import raw_df, raw_row
from tillroll.functions import (
    batch_fingerprint,
    categorize,
    keyword_category,
    label_below,
    mapped_category,
    normalize_keyword,
    normalize_text,
    parse_statement_date,
    percent_of,
    ratio_if_positive,
    row_fingerprint,
    statement_month,
    strip_text,
)


def one(spark, value, build, type_="string"):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return df.select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Trader Joe's #42", "TRADER JOES 42"),
        ("  Coffee &amp; Co. ", "COFFEE AMP CO"),
        ("it‘s ’fine` now", "ITS FINE NOW"),
        ("straße", "STRASSE"),
        ("caffè 2", "CAFF 2"),
        ("a\t\n b", "A B"),
        ("!!!", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_normalize_text(spark, text, expected):
    assert one(spark, text, normalize_text) == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30))
def test_normalized_text_is_words_and_stable(spark, texts):
    df = spark.createDataFrame([(t.replace("\ud800", ""),) for t in texts], "x string")
    once = normalize_text(F.col("x"))
    for row in df.select("x", once.alias("a"), normalize_text(once).alias("b")).collect():
        assert row["a"] == row["b"]
        assert row["a"] == " ".join(row["a"].split())
        assert set(row["a"]) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ")


def test_keywords_and_texts_are_normalized_alike(spark):
    words = ["apple.com", "Trader Joe's", "a--b", "ärger", "straße 9", "..."]
    df = spark.createDataFrame([(w,) for w in words], "x string")
    got = [row[0] for row in df.select(normalize_text(F.col("x"))).collect()]
    assert got == [normalize_keyword(w) for w in words]


def test_strip_text_takes_all_white_space(spark):
    assert one(spark, "\t Groceries \n", strip_text) == "Groceries"
    assert one(spark, "a  b", strip_text) == "a  b"
    assert one(spark, None, strip_text) is None


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("01/29/2024", date(2024, 1, 29)),
        ("2024-01-05", None),
        ("1/5/2024", None),
        ("02/30/2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_statement_date(spark, text, expected):
    assert one(spark, text, parse_statement_date) == expected


@pytest.mark.parametrize(
    ("day", "month"),
    [
        (date(2024, 1, 15), "2024-01"),
        (date(2024, 1, 28), "2024-01"),
        (date(2024, 1, 29), "2024-02"),
        (date(2024, 1, 31), "2024-02"),
        (date(2024, 2, 28), "2024-02"),
        (date(2024, 2, 29), "2024-03"),
        (date(2024, 12, 31), "2025-01"),
        (None, None),
    ],
)
def test_statement_month(spark, day, month):
    assert one(spark, day, statement_month, "date") == month


def test_statement_month_cut_day(spark):
    assert one(spark, date(2024, 3, 15), lambda d: statement_month(d, 15), "date") == "2024-04"
    assert one(spark, date(2024, 3, 31), lambda d: statement_month(d, 32), "date") == "2024-03"


def test_fingerprint_depends_on_content_only(spark):
    df = raw_df(spark, raw_row(), raw_row(), raw_row(amount=-5.76))
    a, b, c = (row[0] for row in df.select(row_fingerprint()).collect())
    assert a == b != c
    assert len(a) == 64


def test_fingerprint_tells_null_positions_apart(spark):
    rows = [raw_row(Type=None, Memo="x"), raw_row(Type="x", Memo=None)]
    strict = raw_df(spark, *rows).select(row_fingerprint(["Type", "Memo"])).collect()
    loose = raw_df(spark, *rows).select(row_fingerprint(["Type", "Memo"], skip_nulls=True)).collect()
    assert strict[0] != strict[1]
    assert loose[0] == loose[1]


def test_batch_fingerprint(spark):
    got = spark.range(1).select(batch_fingerprint("a"), batch_fingerprint("b")).first()
    assert got[0] == "86f7e437faa5a7fce15d1ddcb9eaeaea377667b8"
    assert got[0] != got[1]


def category_of(spark, text, source, **options):
    df = spark.createDataFrame([(text, source)], "t string, s string")
    return df.select(categorize(normalize_text(F.col("t")), F.col("s"), **options)).first()[0]


@pytest.mark.parametrize(
    ("text", "source", "expected"),
    [
        ("TRADER JOE #99", "Shopping", "Groceries"),
        ("amazon prime*2", None, "Subscriptions"),
        ("AMAZON MKTP", None, "Shopping"),
        ("APPLE.COM/BILL", "Shopping", "Subscriptions"),
        ("SEASHELLS", "Travel", "Gas"),
        ("CORNER STORE", "Health & Wellness", "Health"),
        ("CORNER STORE", "\tGroceries\n", "Groceries"),
        ("CORNER STORE", "groceries", "Uncategorized"),
        ("CORNER STORE", None, "Uncategorized"),
        (None, None, "Uncategorized"),
    ],
)
def test_categorize_default_rules(spark, text, source, expected):
    assert category_of(spark, text, source) == expected


def test_keywords_taken_literally_cannot_match_punctuation(spark):
    assert category_of(spark, "APPLE.COM", "Shopping", normalize_keywords=False) == "Shopping"


def test_categorize_without_rules_or_map(spark):
    assert category_of(spark, "GYM", "Gas", rules=[], mapping={}, fallback="?") == "?"
    df = spark.createDataFrame([("GYM",)], "t string")
    assert df.select(keyword_category(F.col("t"), [("...", "x")])).first()[0] is None
    assert df.select(mapped_category(F.col("t"), {})).first()[0] is None


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -1.0), (1.0, None)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(ratio_if_positive(a, b)).collect()] == [0.25, None, None, None]
    assert [r[0] for r in df.select(percent_of(a, b)).collect()] == [25.0, None, -100.0, None]


def test_label_below(spark):
    df = spark.createDataFrame([(0.1,), (0.15,), (0.5,), (None,)], "x double")
    labels = df.select(label_below(F.col("x"), [(0.15, "a"), (0.5, "b")], "c")).collect()
    assert [r[0] for r in labels] == ["a", "b", "c", "c"]
    assert df.select(label_below(F.col("x"), [], "z")).first()[0] == "z"
