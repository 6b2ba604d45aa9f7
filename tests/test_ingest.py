import os
import re
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, raw_df, raw_row, rows_of, write_csv
from tillroll.operators import add_ingest_metadata, only_charges, source_files
from tillroll.functions import row_fingerprint
from tillroll.operators.merge import COPY, rows_absent_from, single_copies
from tillroll.plans import bronze_rows, ingest_statements
from tillroll.schemas import BRONZE_SCHEMA, RAW_COLUMNS
from tillroll.sources import read_statements
from tillroll.streaming import ingest_statements_stream

FIRST = [raw_row("01/05/2024", "A"), raw_row("01/06/2024", "B"), raw_row("01/07/2024", "PAY", amount=9.0)]
SECOND = [raw_row("01/06/2024", "B"), raw_row("04/07/2024", "C, D", Memo="m"), raw_row("04/08/2024", 'a "b"', amount=1.0)]


@pytest.fixture
def drop(tmp_path):
    path = str(tmp_path / "drop")
    write_csv(f"{path}/q1.csv", FIRST)
    return path


def names(spark, bronze):
    return sorted(r[0] for r in spark.read.parquet(bronze).select("Description").collect())


def test_metadata_columns_and_charge_filter(spark):
    rows = [raw_row(amount=-48.99), raw_row(amount=500.0), raw_row(amount=0.0), raw_row(amount=None)]
    df = only_charges(add_ingest_metadata(raw_df(spark, *rows), "a"))
    assert df.columns == BRONZE_SCHEMA.fieldNames()
    row = df.first()
    assert df.count() == 1 and row["Amount"] == -48.99
    assert row["_source_file"] == "" and row["_ingest_ts"] is not None


def test_fingerprint_ignores_source_and_batch_id_does_not(spark):
    df = raw_df(spark, raw_row())
    a, b = (add_ingest_metadata(df, s).select("_row_hash", "_batch_id").first() for s in "ab")
    assert a[0] == b[0] and a[1] != b[1]


def test_read_keeps_values(spark, drop):
    write_csv(f"{drop}/q2.csv", SECOND)
    doubled = {"escape": '"'}
    got = rows_of(read_statements(spark, drop, options=doubled))
    assert got == sorted(FIRST + SECOND, key=repr)


def test_other_files_are_not_read(spark, drop):
    with open(f"{drop}/README.md", "w") as file:
        file.write("# notes\n\nnot a statement\n")
    assert rows_of(read_statements(spark, drop)) == sorted(FIRST, key=repr)


def test_malformed_rows_fail(spark, drop):
    write_csv(f"{drop}/bad.csv", [("01/01/2024", "01/01/2024", "X", "Y", "Sale", "not a number", "")])
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        read_statements(spark, drop).collect()


def test_swapped_header_fails(spark, drop):
    header = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    write_csv(f"{drop}/swapped.csv", SECOND, header)
    with pytest.raises(Exception, match="header"):
        read_statements(spark, drop).collect()


def test_charge_filter_reaches_the_reader(spark, drop):
    text = plan(bronze_rows(read_statements(spark, drop), drop))
    assert "LessThan(Amount,0.0)" in text


def test_batch_ingest_is_idempotent(spark, drop, tmp_path):
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        ingest_statements(spark, drop, bronze)
        assert names(spark, bronze) == ["A", "B"]
    write_csv(f"{drop}/q2.csv", SECOND)
    ingest_statements(spark, drop, bronze)
    assert names(spark, bronze) == ["A", "B", "C, D"]
    table = spark.read.parquet(bronze)
    assert [f.name for f in table.schema] == [*BRONZE_SCHEMA.fieldNames(), "_month"]
    files = sorted(os.path.basename(r[0]) for r in source_files(table).collect())
    assert files == ["q1.csv", "q2.csv"]


def test_equal_purchases_in_one_batch_are_both_kept(spark, drop, tmp_path):
    write_csv(f"{drop}/q2.csv", SECOND)
    keep, single = str(tmp_path / "keep"), str(tmp_path / "single")
    ingest_statements(spark, drop, keep)
    ingest_statements(spark, drop, single, dedupe_within_batch=True)
    assert names(spark, keep).count("B") == 2
    assert names(spark, single).count("B") == 1


def run_stream(spark, drop, tmp_path, **options):
    query = ingest_statements_stream(
        spark, drop, str(tmp_path / "stream"), str(tmp_path / "checkpoint"), **options
    )
    query.awaitTermination()
    assert query.exception() is None
    return str(tmp_path / "stream")


def test_stream_picks_up_drops_without_repeats(spark, drop, tmp_path):
    bronze = run_stream(spark, drop, tmp_path)
    assert names(spark, bronze) == ["A", "B"]
    assert names(spark, run_stream(spark, drop, tmp_path)) == ["A", "B"]
    write_csv(f"{drop}/q2.csv", SECOND)
    assert names(spark, run_stream(spark, drop, tmp_path)) == ["A", "B", "C, D"]
    shutil.copy(f"{drop}/q1.csv", f"{drop}/copy.csv")
    assert names(spark, run_stream(spark, drop, tmp_path)) == ["A", "B", "C, D"]


@pytest.mark.parametrize("files", [1, 10])
def test_stream_equals_batch_with_dedupe(spark, drop, tmp_path, files):
    write_csv(f"{drop}/q2.csv", SECOND)
    batch = str(tmp_path / "batch")
    ingest_statements(spark, drop, batch, dedupe_within_batch=True)
    stream = run_stream(spark, drop, tmp_path, max_files_per_trigger=files)
    columns = [*RAW_COLUMNS, "_row_hash", "_batch_id"]
    quoted = [F.col(f"`{c}`") for c in columns]
    assert rows_of(spark.read.parquet(stream).select(*quoted)) == rows_of(
        spark.read.parquet(batch).select(*quoted)
    )


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in re.findall(r"shuffle_[0-9]+_[0-9]+_[0-9]+", found.mkString(" "))}


@pytest.mark.parametrize("keep_copies", [False, True])
def test_a_stream_leaves_no_shuffle_files(spark, drop, tmp_path, keep_copies):
    """Spark removes them when the driver collects garbage: those of all merges would lie on the disk until then."""
    write_csv(f"{drop}/q2.csv", SECOND)
    before = shuffle_files(spark)
    run_stream(spark, drop, tmp_path, max_files_per_trigger=1, keep_copies=keep_copies)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("keep_copies", [False, True])
def test_rows_are_made_single_by_one_shuffle_without_keys(spark, keep_copies):
    """Also rows that differ, but have the same fingerprint."""
    same = [raw_row(text="A|B", category="C"), raw_row(text="A", category="B|C"), raw_row(), raw_row(Memo="")]
    rows = raw_df(spark, *same, raw_row(), raw_row(text="X")).withColumn("_source_file", F.lit("f"))
    single = single_copies(rows, row_fingerprint(), keep_copies=keep_copies)
    exchanges = re.findall(r"Exchange .*", plan(single))
    assert len(exchanges) == 1 and "_deal" in exchanges[0]
    assert single.columns == [*rows.columns, COPY]
    got = sorted((row["Description"][0], row[COPY]) for row in single.collect())
    assert got == [("A", 1), ("C", 1), *([("C", 2)] if keep_copies else []), ("X", 1)]


def test_a_stream_goes_on_with_a_table_without_months(spark, drop, tmp_path):
    bronze = run_stream(spark, drop, tmp_path, by_month=False, keep_copies=True)
    write_csv(f"{drop}/q2.csv", [*SECOND, SECOND[1]])
    run_stream(spark, drop, tmp_path, keep_copies=True)
    assert names(spark, bronze) == ["A", "B", "C, D", "C, D"]
    assert spark.read.parquet(bronze).columns == BRONZE_SCHEMA.names


def test_stream_lost_checkpoint_adds_nothing(spark, drop, tmp_path):
    bronze = run_stream(spark, drop, tmp_path)
    query = ingest_statements_stream(spark, drop, bronze, str(tmp_path / "other-checkpoint"))
    query.awaitTermination()
    assert names(spark, bronze) == ["A", "B"]


def test_continuous_stream_can_be_listed_and_stopped(spark, drop, tmp_path):
    query = ingest_statements_stream(
        spark,
        drop,
        str(tmp_path / "stream"),
        str(tmp_path / "checkpoint"),
        processing_time="1 second",
        name="drops",
    )
    try:
        query.processAllAvailable()
        assert "drops" in [q.name for q in spark.streams.active]
        assert names(spark, str(tmp_path / "stream")) == ["A", "B"]
    finally:
        query.stop()
    assert not query.isActive


def test_checkpoint_inside_the_table_is_refused(spark, drop, tmp_path):
    with pytest.raises(ValueError):
        ingest_statements_stream(spark, drop, str(tmp_path / "t"), str(tmp_path / "t/_checkpoint"))


def equal_purchases(drop):
    """Three files with one equal purchase each, one of them twice."""
    for number in range(3):
        write_csv(f"{drop}/same{number}.csv", [raw_row(text="SAME")] * (2 if number == 1 else 1))


@pytest.mark.parametrize("files", [1, 7, 1000])
@pytest.mark.parametrize("keep_copies, count", [(False, 1), (True, 2)])
def test_the_file_cap_decides_nothing(spark, drop, tmp_path, files, keep_copies, count):
    equal_purchases(drop)
    bronze = run_stream(spark, drop, tmp_path, max_files_per_trigger=files, keep_copies=keep_copies)
    assert names(spark, bronze).count("SAME") == count
    ingest_statements(spark, drop, str(tmp_path / "batch"), keep_copies=True)
    assert names(spark, str(tmp_path / "batch")).count("SAME") == 2


def test_a_half_committed_merge_is_completed(spark, drop, tmp_path):
    equal_purchases(drop)
    whole, half = str(tmp_path / "whole"), str(tmp_path / "half")
    ingest_statements(spark, drop, whole, keep_copies=True)
    table = spark.read.parquet(whole)
    for lost in [r["_row_hash"] for r in table.where("Description = 'SAME'").collect()]:
        path = f"{half}-{lost[:8]}"
        table.where(F.col("_row_hash") != lost).write.partitionBy("_month").parquet(path)
        ingest_statements(spark, drop, path, keep_copies=True)
        assert names(spark, path) == names(spark, whole)


def test_ingest_searches_the_months_of_new_files_only(spark, drop, tmp_path):
    bronze = str(tmp_path / "bronze")
    ingest_statements(spark, drop, bronze)
    batch = spark.createDataFrame([("x", "2031-05"), ("y", "1990-01")], "_row_hash string, _month string")
    text = plan(rows_absent_from(batch, spark.read.parquet(bronze), "_row_hash", prune_by="_month"))
    assert re.search(r"PartitionFilters: \[.*_month#\d+ IN \((1990-01,2031-05|2031-05,1990-01)\)", text)


def executions(spark):
    """Number and physical plan of the SQL executions of the session so far."""
    store = spark._jsparkSession.sharedState().statusStore()
    found = store.executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


@pytest.mark.parametrize("options", [{}, {"keep_copies": True}, {"dedupe_within_batch": True}])
def test_files_are_parsed_once(spark, tmp_path, options):
    source, bronze = str(tmp_path / "drop"), str(tmp_path / "bronze")
    write_csv(f"{source}/a.csv", [raw_row(f"01/{d:02d}/2024") for d in range(1, 9)])
    ingest_statements(spark, source, bronze, **options)
    write_csv(f"{source}/b.csv", [raw_row(f"02/{d:02d}/2024") for d in range(1, 9)])
    before = set(executions(spark))
    ingest_statements(spark, source, bronze, **options)
    plans = [text for number, text in executions(spark).items() if number not in before]
    trees = [text.split("== Initial Plan ==")[0] for text in plans]  # what ran, not what was planned at first
    scans = [scan for tree in trees for scan in re.findall(r"Scan csv +\(\d+\)", tree)]
    assert len(plans) > 1 and len(scans) == 1
    assert spark.read.parquet(bronze).count() == 16


def test_nothing_new_and_nothing_at_all(spark, tmp_path):
    """A batch without rows, and one of which every row is known, add nothing and leave nothing staged."""
    source, bronze = str(tmp_path / "drop"), str(tmp_path / "bronze")
    write_csv(f"{source}/a.csv", [raw_row()])
    ingest_statements(spark, source, bronze)
    write_csv(f"{tmp_path}/none/b.csv", [])
    ingest_statements(spark, f"{tmp_path}/none", bronze)
    ingest_statements(spark, source, bronze)
    assert spark.read.parquet(bronze).count() == 1
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + "/tillroll"
    assert not os.path.isdir(shared) or not any(name.startswith("merge-batch") for name in os.listdir(shared))
