from datetime import date

import pytest

from tests.helpers import plan, raw_df, raw_row, rows_of
from tillroll.operators import (
    QualityError,
    add_ingest_metadata,
    month_slice,
    normalize_statements,
)
from tillroll.plans import build_silver, statements
from tillroll.rules import QualityRule
from tillroll.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tillroll.sources import append_partitioned, append_table, count_per_value, read_table


def bronze(spark, *rows):
    return add_ingest_metadata(raw_df(spark, *rows), "test")


def silver(spark, *rows, **options):
    return normalize_statements(bronze(spark, *rows), **options)


def test_schema(spark):
    got = silver(spark, raw_row()).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_values(spark):
    row = silver(spark, raw_row("01/29/2024", "Trader Joe's #99", "Shopping", -75.0, Memo="m")).first()
    assert row["description"] == "Trader Joe's #99"
    assert row["description_norm"] == "TRADER JOES 99"
    assert row["chase_category"] == "Shopping"
    assert row["category"] == "Groceries"
    assert row["amount"] == 75.0
    assert row["is_credit"] is False
    assert row["trans_date"] == row["post_date"] == date(2024, 1, 29)
    assert row["statement_month"] == "2024-02"
    assert (row["memo"], row["transaction_type"]) == ("m", "Sale")
    assert row["_silver_ts"] is not None


def test_credits_and_missing_values(spark):
    credit, nothing = silver(
        spark,
        raw_row(amount=10.0),
        raw_row(day=None, text=None, category=None, amount=None),
    ).collect()
    assert (credit["amount"], credit["is_credit"]) == (-10.0, True)
    assert (nothing["amount"], nothing["is_credit"]) == (None, None)
    assert (nothing["trans_date"], nothing["statement_month"]) == (None, None)
    assert (nothing["description_norm"], nothing["category"]) == ("", "Uncategorized")


def test_parameters(spark):
    row = silver(
        spark,
        raw_row("2024-01-20", "MY SHOP", "Src"),
        rules=[("other", "x")],
        mapping={"Src": "Mapped"},
        cut_day=15,
        date_format="yyyy-MM-dd",
    ).first()
    assert (row["statement_month"], row["category"]) == ("2024-02", "Mapped")


def test_no_python_and_no_shuffle(spark):
    text = plan(silver(spark, raw_row()))
    assert "Python" not in text and "Exchange" not in text


def test_text_is_normalized_once_per_row(spark, tmp_path):
    append_table(bronze(spark, raw_row()), str(tmp_path / "b"))
    text = plan(normalize_statements(spark.read.parquet(str(tmp_path / "b"))))
    assert text.count("regexp_replace(replace(") == 1


def test_build_from_new_rows_only(spark, tmp_path):
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    append_table(bronze(spark, raw_row("01/05/2024", "A")), b)
    build_silver(spark, b, s)
    last = read_table(spark, b).agg({"_ingest_ts": "max"}).first()[0]
    append_table(bronze(spark, raw_row("06/05/2024", "B")), b)
    build_silver(spark, b, s, ingested_since=last)
    build_silver(spark, b, s, ingested_since=last)
    assert [r[0] for r in rows_of(read_table(spark, s, SILVER_SCHEMA).select("description"))] == ["A", "B"]


def test_build_is_incremental(spark, tmp_path):
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    append_table(bronze(spark, raw_row("01/05/2024", "A"), raw_row("01/30/2024", "B")), b)
    for _ in range(2):
        build_silver(spark, b, s)
        assert rows_of(read_table(spark, s, SILVER_SCHEMA).select("description", "statement_month")) == [
            ("A", "2024-01"),
            ("B", "2024-02"),
        ]
    append_table(bronze(spark, raw_row("02/05/2024", "C"), raw_row(None, "D")), b)
    build_silver(spark, b, s)
    build_silver(spark, b, s)
    table = read_table(spark, s, SILVER_SCHEMA)
    assert rows_of(count_per_value(table, "statement_month")) == sorted(
        [(None, 1), ("2024-01", 1), ("2024-02", 2)], key=repr
    )
    assert {p.name for p in (tmp_path / "silver").glob("statement_month=*")} == {
        "statement_month=2024-01",
        "statement_month=2024-02",
        "statement_month=__HIVE_DEFAULT_PARTITION__",
    }


def test_build_after_a_change_of_the_cut_day(spark, tmp_path):
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    append_table(bronze(spark, raw_row("01/20/2024", "A"), raw_row("05/20/2024", "B")), b)
    build_silver(spark, b, s)
    build_silver(spark, b, s, cut_day=15, search_all_months=True)
    assert read_table(spark, s, SILVER_SCHEMA).count() == 2


def test_month_slice_reads_one_partition(spark, tmp_path):
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    append_table(bronze(spark, raw_row("01/05/2024", "GYM"), raw_row("03/05/2024", "GYM")), b)
    build_silver(spark, b, s)
    df = month_slice(read_table(spark, s, SILVER_SCHEMA), "2024-03", "Health")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(statement_month" in text
    assert "EqualTo(category,Health)" in text
    assert df.count() == 1 and month_slice(read_table(spark, s), "2024-02").count() == 0


def test_gate_runs_before_rows_are_published(spark, tmp_path):
    b, s, log = (str(tmp_path / name) for name in ("bronze", "silver", "log"))
    append_table(bronze(spark, raw_row("01/05/2024", "A"), raw_row("bad date", "B")), b)
    with pytest.raises(QualityError, match="no_null_trans_date"):
        build_silver(spark, b, s, gate_log=log)
    assert not (tmp_path / "silver").exists()
    assert spark.read.parquet(log).count() == 7
    lenient = [QualityRule("no_null_trans_date", "trans_date IS NOT NULL", "WARN")]
    results = build_silver(spark, b, s, gate_log=log, gate_rules=lenient)
    assert [r.failed_rows for r in results] == [1]
    assert read_table(spark, s, SILVER_SCHEMA).count() == 2


def test_hot_month_is_split_when_written(spark, tmp_path):
    """A month with nearly all rows becomes several files; the others one each."""
    from pyspark.sql import functions as F

    from tillroll.sources import append_partitioned

    df = spark.range(0, 40_000, 1, 16).select(
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        F.when(F.col("id") % 20 == 0, F.concat(F.lit("2023-0"), (F.col("id") % 3 + 1).cast("string")))
        .otherwise("2024-01")
        .alias("statement_month"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        append_partitioned(df, str(tmp_path / "t"), "statement_month")
    finally:
        spark.conf.set(key, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("statement_month=*")}
    assert files.pop("statement_month=2024-01") > 4
    assert set(files.values()) == {1}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_a_fingerprint_that_follows_from_the_row_is_not_shuffled(spark, tmp_path):
    """Other ones, such as those of copies, go along; all come back as they were."""
    rows = bronze(spark, raw_row(), raw_row(day=None, amount=None)).collect()
    rows = [row.asDict() for row in rows] + [{**rows[0].asDict(), "_row_hash": h} for h in ("=", "!", "", "other", None)]
    table = spark.createDataFrame([tuple(row.values()) for row in rows], BRONZE_SCHEMA)
    hidden = statements._hide_fingerprint(table)
    assert [row["_row_hash"] for row in hidden.collect()] == ["=", "=", "!=", "!!", "!", "!other", None]
    assert rows_of(statements._show_fingerprint(hidden)) == rows_of(table)


def test_rows_are_typed_after_the_shuffle_and_unstaged_without_a_join(spark, tmp_path, monkeypatch):
    b, s, log = (str(tmp_path / name) for name in ("bronze", "silver", "log"))
    shuffled, staged = [], []
    monkeypatch.setattr(
        statements, "append_partitioned", lambda df, *rest, **named: (shuffled.append(df.columns), append_partitioned(df, *rest, **named))
    )
    monkeypatch.setattr(statements, "append_table", lambda df, path: (staged.append(df.count()), append_table(df, path)))
    append_table(bronze(spark, raw_row("01/05/2024", "A"), raw_row("02/05/2024", "B"), raw_row("02/05/2024", "B")), b)
    build_silver(spark, b, s, gate_log=log)
    append_table(bronze(spark, raw_row("03/05/2024", "C")), b)
    build_silver(spark, b, s, gate_log=log)
    assert staged == []
    append_table(bronze(spark, raw_row("02/06/2024", "D")), b)
    build_silver(spark, b, s, gate_log=log)
    assert staged == [1]
    assert all("description_norm" not in columns for columns in shuffled) and len(shuffled) == 3
    found = read_table(spark, s, SILVER_SCHEMA).select("description", "description_norm", "statement_month")
    assert [r[0] + r[1] + r[2][-1] for r in rows_of(found)] == ["AA1", "BB2", "BB2", "CC3", "DD2"]
    assert read_table(spark, s, SILVER_SCHEMA).where("length(_row_hash) = 64").count() == 5
