"""Lines that do not parse, and micro-batches that are delivered twice."""

import os
import shutil

import pytest

from tests.helpers import raw_row, rows_of, write_csv
from tillroll.operators.quality import QualityError
from tillroll.plans import Rejects, ingest_statements
from tillroll.schemas import RAW_COLUMNS
from tillroll.sources import read_statements
from tillroll.streaming import ingest as stream_module
from tillroll.streaming import ingest_statements_stream

GOOD = [raw_row("01/05/2024", "A"), raw_row("01/06/2024", "B"), raw_row("01/07/2024", "PAY", amount=9.0)]
BAD = ["01/08/2024,01/08/2024,C,Food,Sale,not a number,", "01/09/2024,01/09/2024,D", "x" * 5000, "1,2,3,4,5,-6.0,7,8"]


@pytest.fixture
def drop(tmp_path):
    path = str(tmp_path / "drop")
    write_csv(f"{path}/q1.csv", GOOD)
    with open(f"{path}/q1.csv", "a") as file:
        file.write("\r\n".join([*BAD, BAD[0], ""]))
    return path


def names(spark, bronze):
    return sorted(r[0] for r in spark.read.parquet(bronze).select("Description").collect())


def lines(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("line").collect())


def test_rejected_lines_are_read_whole(spark, drop):
    rows = read_statements(spark, drop, keep_rejected=True).cache()
    assert sorted(r["_rejected_line"] for r in rows.collect() if r["_rejected_line"]) == sorted([*BAD, BAD[0]])
    assert rows_of(rows.where("_rejected_line IS NULL").select(*RAW_COLUMNS)) == sorted(GOOD, key=repr)
    rows.unpersist()


def test_one_bad_line_ends_no_ingest_that_asks_for_it(spark, drop, tmp_path):
    bronze, rejects = str(tmp_path / "bronze"), Rejects(str(tmp_path / "rejects"), str(tmp_path / "log"))
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        ingest_statements(spark, drop, bronze)
    for _ in range(2):  # the second run adds nothing
        ingest_statements(spark, drop, bronze, rejects=rejects)
        assert names(spark, bronze) == ["A", "B"]
        assert lines(spark, rejects.path) == sorted(BAD)
    log = spark.read.parquet(rejects.log_path).select("rule_name", "severity", "total_rows", "failed_rows")
    assert rows_of(log) == [("line_parses", "WARN", 8, 5)] * 2
    files = {os.path.basename(r[0]) for r in spark.read.parquet(rejects.path).select("_source_file").collect()}
    assert files == {"q1.csv"}


def test_accepted_rows_equal_those_of_clean_files(spark, drop, tmp_path):
    clean = str(tmp_path / "clean")
    write_csv(f"{clean}/q1.csv", GOOD)
    ingest_statements(spark, clean, str(tmp_path / "a"))
    ingest_statements(spark, drop, str(tmp_path / "b"), rejects=Rejects(str(tmp_path / "rejects")))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    assert a.schema == b.schema
    same = [c for c in a.columns if c not in ("_ingest_ts", "_source_file", "_batch_id")]
    assert rows_of(a.select(same)) == rows_of(b.select(same))


def test_an_error_stops_before_the_merge(spark, drop, tmp_path):
    bronze, rejects = str(tmp_path / "bronze"), Rejects(str(tmp_path / "rejects"), str(tmp_path / "log"), "ERROR")
    with pytest.raises(QualityError, match="line_parses"):
        ingest_statements(spark, drop, bronze, rejects=rejects)
    assert not os.path.exists(bronze)
    assert len(lines(spark, rejects.path)) == len(BAD)
    with pytest.raises(ValueError, match="log"):
        Rejects("somewhere", severity="ERROR")


def test_a_swapped_header_still_fails(spark, drop, tmp_path):
    write_csv(f"{drop}/swapped.csv", GOOD, [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]])
    with pytest.raises(Exception, match="header"):
        ingest_statements(spark, drop, str(tmp_path / "bronze"), rejects=Rejects(str(tmp_path / "rejects")))


def run_stream(spark, drop, tmp_path, **options):
    query = ingest_statements_stream(spark, drop, str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    assert query.exception() is None
    return str(tmp_path / "bronze")


def test_stream_with_rejected_lines(spark, drop, tmp_path):
    rejects = Rejects(str(tmp_path / "rejects"), str(tmp_path / "log"))
    write_csv(f"{drop}/q2.csv", [raw_row("02/05/2024", "E")])
    bronze = run_stream(spark, drop, tmp_path, rejects=rejects, max_files_per_trigger=1)
    assert names(spark, bronze) == ["A", "B", "E"]
    assert lines(spark, rejects.path) == sorted(BAD)
    assert sorted(r["failed_rows"] for r in spark.read.parquet(rejects.log_path).collect()) == [0, 5]


def test_a_batch_delivered_again_is_passed_over(spark, tmp_path, monkeypatch):
    drop, checkpoint = str(tmp_path / "drop"), str(tmp_path / "checkpoint")
    for i in range(4):
        write_csv(f"{drop}/q{i}.csv", [raw_row("01/05/2024", f"A{i}")])
        bronze = run_stream(spark, drop, tmp_path)
    assert sorted(n for n in os.listdir(f"{checkpoint}/merged") if n.isdigit()) == ["2", "3"]
    # Spark has not noted that the last batch was done, and delivers it again
    for name in ("3", ".3.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    merge = stream_module.merge_bronze
    with monkeypatch.context() as patch:
        patch.setattr(stream_module, "merge_bronze", lambda *a, **k: pytest.fail("searched the table again"))
        run_stream(spark, drop, tmp_path)
    assert os.path.exists(f"{checkpoint}/commits/3")
    assert names(spark, bronze) == ["A0", "A1", "A2", "A3"]

    # a batch whose marker was not written yet is merged again, and adds nothing
    merged = []
    for name in ("commits/3", "commits/.3.crc", "merged/3"):
        os.remove(f"{checkpoint}/{name}")
    with monkeypatch.context() as patch:
        patch.setattr(stream_module, "merge_bronze", lambda *a, **k: merged.append(1) or merge(*a, **k))
        run_stream(spark, drop, tmp_path)
    assert merged == [1]
    assert names(spark, bronze) == ["A0", "A1", "A2", "A3"]


def test_a_new_checkpoint_has_no_markers(spark, drop, tmp_path):
    rejects = Rejects(str(tmp_path / "rejects"))
    run_stream(spark, drop, tmp_path, rejects=rejects)
    shutil.rmtree(tmp_path / "bronze")
    shutil.rmtree(tmp_path / "checkpoint")
    assert names(spark, run_stream(spark, drop, tmp_path, rejects=rejects)) == ["A", "B"]
