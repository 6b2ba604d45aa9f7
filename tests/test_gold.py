import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, raw_df, raw_row, rows_of, spend_df, write_csv
from tillroll.functions import parse_statement_date, statement_month
from tillroll.operators import (
    add_ingest_metadata,
    compact_table,
    detect_recurring,
    file_sizes,
    fixed_vs_variable,
    monthly_by_category,
    normalize_statements,
)
from tillroll.plans import StatementPaths, build_gold, build_silver, ingest_statements
from tillroll.schemas import SILVER_SCHEMA
from tillroll.sources import append_partitioned, append_table, read_table, scratch_path
from tillroll.sources.tables import files_by_directory

ROWS = [raw_row(f"{m:02d}/{d:02d}/2024", text, amount=-a) for m in range(1, 7)
        for d, text, a in ((3, "NETFLIX", 15.49), (9, "CORNER SHOP", 10.0 * m), (29, "GYM", 20.0))]


@pytest.fixture
def silver(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = normalize_statements(add_ingest_metadata(raw_df(spark, *ROWS), "t"))
    append_partitioned(rows, path, "statement_month")
    return path


def test_gold_tables_equal_the_operators(spark, silver, tmp_path):
    gold = str(tmp_path / "gold")
    rows = read_table(spark, silver, SILVER_SCHEMA)
    for _ in range(2):  # a second build replaces the first
        build_gold(spark, silver, gold)
    for name, want in {
        "monthly_by_category": monthly_by_category(rows),
        "fixed_vs_variable": fixed_vs_variable(rows),
        "recurring": detect_recurring(rows),
    }.items():
        got = spark.read.parquet(f"{gold}/{name}")
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want)
        assert file_sizes(spark, f"{gold}/{name}").count() == 1
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_gold_reads_only_what_it_needs(spark, silver):
    rows = read_table(spark, silver, SILVER_SCHEMA)
    for result in (monthly_by_category(rows), fixed_vs_variable(rows)):
        assert "ReadSchema: struct<amount:double,category:string,is_credit:boolean>" in plan(result)


def test_files_to_gold(spark, tmp_path):
    paths = StatementPaths.under(str(tmp_path / "base"), str(tmp_path / "drop"))
    write_csv(f"{paths.source}/q1.csv", ROWS)
    ingest_statements(spark, paths.source, paths.bronze)
    build_silver(spark, paths.bronze, paths.silver, gate_log=paths.quality_log)
    build_gold(spark, paths.silver, paths.gold)
    recurring = {r["description_norm"]: r["recurrence_type"] for r in spark.read.parquet(paths.recurring).collect()}
    assert recurring == {"NETFLIX": "MONTHLY", "GYM": "MONTHLY", "CORNER SHOP": "IRREGULAR"}
    spend = {r[0] for r in spark.read.parquet(paths.monthly).select("statement_month").collect()}
    assert spend == {f"2024-{m:02d}" for m in range(1, 8)}
    assert spark.read.parquet(paths.stability).count() == 3
    assert spark.read.parquet(paths.quality_log).count() == 7


@pytest.mark.parametrize("partition_by", [None, "category"])
@pytest.mark.parametrize("cluster_by", [[], ["statement_month", "amount"]])
def test_compaction_keeps_all_rows(spark, tmp_path, partition_by, cluster_by):
    rows = [(f"M{i % 9}", f"C{i % 3}", float(i % 4), f"2024-{i % 6 + 1:02d}") for i in range(300)]
    df, path, out = spend_df(spark, *rows), str(tmp_path / "in"), str(tmp_path / "out")
    append_table(df.repartition(12), path)
    result = compact_table(spark, path, out, partition_by=partition_by, cluster_by=cluster_by)
    after = spark.read.parquet(out)
    assert rows_of(after.select(df.columns)) == rows_of(df)
    assert result.files_before == 12
    assert result.files_after == (3 if partition_by else 1) == file_sizes(spark, out).count()
    assert result.bytes_after > 0


def test_compaction_spreads_equal_rows_and_orders_files(spark, tmp_path):
    rows = [("SAME", "C", 1.0, "2024-01")] * 4000 + [("OTHER", "C", 2.0, "2024-02")] * 2000
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    append_table(spend_df(spark, *rows).repartition(8), path)
    size = file_sizes(spark, path).agg({"file_size": "sum"}).first()[0]
    compact_table(spark, path, out, cluster_by=["statement_month"], target_file_bytes=size // 6)
    per_file = spark.read.parquet(out).groupBy("_metadata.file_path").agg(
        F.count("*"), F.countDistinct("statement_month")
    )
    counts = [r[1] for r in per_file.collect()]
    assert len(counts) >= 6 and max(counts) < 2500 and sum(counts) == 6000
    assert sum(r[2] > 1 for r in per_file.collect()) <= 1


def test_compaction_does_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "in")
    append_table(spend_df(spark, ("A", "C", 1.0, "2024-01")), path)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        compact_table(spark, path, path)


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/tillroll/x-")


CODES = [("a", "01"), ("b", "1"), ("c", None), ("d", "A7"), ("e", "01")]


def test_compaction_keeps_values_of_directories(spark, tmp_path):
    df, path, out = spark.createDataFrame(CODES[:3], "k string, code string"), str(tmp_path / "in"), str(tmp_path / "out")
    df.write.partitionBy("code").parquet(path)
    compact_table(spark, path, out, partition_by="code")
    assert rows_of(read_table(spark, out, df.schema)) == rows_of(df)


def test_an_empty_text_cannot_name_a_directory(spark, tmp_path):
    df, path = spark.createDataFrame([("a", ""), ("b", "x")], "k string, code string"), str(tmp_path / "in")
    append_table(df, path)
    with pytest.raises(ValueError, match="code"):
        compact_table(spark, path, str(tmp_path / "out"), partition_by="code")
    compact_table(spark, path, str(tmp_path / "plain"), cluster_by=["code"])
    assert rows_of(read_table(spark, str(tmp_path / "plain"))) == rows_of(df)


def test_thresholds_reach_the_gold_tables(spark, silver, tmp_path):
    gold = str(tmp_path / "gold-thresholds")
    build_gold(spark, silver, gold, stability={"fixed_below": 0.0, "variable_below": 0.0}, recurring={"min_months": 99})
    assert {r[0] for r in spark.read.parquet(f"{gold}/fixed_vs_variable").select("classification").collect()} == {"DISCRETIONARY"}
    assert not any(r[0] for r in spark.read.parquet(f"{gold}/recurring").select("is_recurring").collect())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F

    from tillroll.sources import read_table, replace_table

    path = str(tmp_path / "gold" / "report")
    replace_table(spark.range(3), path)
    bad = spark.range(1000).withColumn("id", F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        replace_table(bad, path)
    assert rows_of(read_table(spark, path)) == [(0,), (1,), (2,)]
    replace_table(spark.range(5), path + "/")
    assert read_table(spark, path).count() == 5
    # A table may be made from itself, and nothing stays beside it.
    replace_table(read_table(spark, path).where("id > 1"), path)
    assert rows_of(read_table(spark, path)) == [(2,), (3,), (4,)]
    assert [p.name for p in (tmp_path / "gold").iterdir() if not p.name.startswith(".")] == ["report"]


def test_a_table_that_cannot_take_its_place_leaves_the_old_one(spark, tmp_path, monkeypatch):
    from tillroll.sources import tables

    path = str(tmp_path / "gold" / "report")
    tables.replace_table(spark.range(3), path)
    rename = tables._rename

    def broken(files, source, target):
        if "_new-" in source.toString():
            raise OSError("no")
        rename(files, source, target)

    monkeypatch.setattr(tables, "_rename", broken)
    with pytest.raises(OSError):
        tables.replace_table(spark.range(9), path)
    assert tables.read_table(spark, path).count() == 3


def skipped(folder, column, low, high):
    """Share of the files whose statistics say that no value of ``column`` lies in ``low`` to ``high``."""
    spans = []
    for place in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(place).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans += [(s.min, s.max) for s in stats if s.has_min_max]
    return sum(last < low or first > high for first, last in spans) / len(spans)


def test_interleaved_clustering_serves_both_columns(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id", "cast(hash(id) % 1000 as double) a", "concat('t', lpad(abs(hash(id, 7)) % 1000, 3, '0')) b"
    )
    path = str(tmp_path / "in")
    append_table(df.repartition(4), path)
    size = file_sizes(spark, path).agg({"file_size": "sum"}).first()[0]
    share = {}
    for interleave in (False, True):
        out = str(tmp_path / f"out-{interleave}")
        compact_table(spark, path, out, cluster_by=["a", "b"], interleave=interleave, target_file_bytes=size // 60)
        assert rows_of(spark.read.parquet(out)) == rows_of(df)
        share[interleave] = skipped(out, "b", "t100", "t110"), skipped(out, "a", 100.0, 110.0)
    assert share[False][0] == 0 and share[True][0] > 0.6 and share[True][1] > 0.6


@pytest.mark.parametrize("partition_by", [None, "c"])
def test_interleaving_keeps_rows_of_all_kinds(spark, tmp_path, partition_by):
    """NULL, NaN, dates, decimals, long texts, a column without values and a table without rows."""
    df = spark.range(200).selectExpr(
        "if(id % 7 = 0, null, if(id % 5 = 0, double('NaN'), double(id))) x",
        "if(id % 3 = 0, null, date_add(date '2024-01-01', cast(id as int))) d",
        "cast(id / 3 as decimal(9,2)) m",
        "repeat(cast(id as string), 100) t",
        "cast(null as long) n",
        "concat('c', id % 2) c",
    )
    text = [F.col(c).cast("string") for c in df.columns]  # as NaN is not equal to itself
    for rows, name in ((df, "some"), (df.limit(0), "none")):
        path, out = str(tmp_path / f"in-{name}"), str(tmp_path / f"out-{name}")
        append_table(rows, path)
        columns = ["x", "d", "m", "t", "n"]
        compact_table(spark, path, out, cluster_by=columns, interleave=True, partition_by=partition_by, schema=df.schema)
        assert rows_of(read_table(spark, out, df.schema).select(*text)) == rows_of(rows.select(*text))
    with pytest.raises(ValueError, match="columns can be interleaved"):
        compact_table(spark, path, str(tmp_path / "x"), cluster_by=["x"] * 8, interleave=True)


@pytest.mark.parametrize("interleave", [False, True])
def test_a_task_sorts_a_bounded_part(spark, tmp_path, interleave):
    """Files are cut smaller where the rows of one would take more than the memory for a sort."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    append_table(spark.range(20_000).selectExpr("id", "id % 7 AS a", "double(id) AS b"), path)
    result = compact_table(spark, path, out, cluster_by=["a", "b"], interleave=interleave, sort_bytes=100_000)
    assert result.files_after >= 9
    largest = spark.read.parquet(out).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest <= 4_000
    assert rows_of(spark.read.parquet(out)) == rows_of(spark.read.parquet(path))


def test_derived_columns_are_not_shuffled(spark, tmp_path):
    """Rows are typed and fingerprinted after they are dealt out to the tasks that write them."""
    raw = raw_df(spark, *[raw_row(day=f"{m:02d}/{d:02d}/2024", text=f"SHOP {d}") for m in (1, 2) for d in (3, 30)])  # one is no date
    month = statement_month(parse_statement_date(F.col("Transaction Date")))

    def typed(rows):
        below = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "sha2" not in below and "RebalancePartitions" in below
        return normalize_statements(add_ingest_metadata(rows, "drop"))

    append_partitioned(raw, str(tmp_path / "t"), "statement_month", deal_by=month, derive=typed)
    kept = [name for name in SILVER_SCHEMA.fieldNames() if name not in ("_ingest_ts", "_silver_ts")]
    found = read_table(spark, str(tmp_path / "t"), SILVER_SCHEMA).select(kept)
    assert rows_of(found) == rows_of(normalize_statements(add_ingest_metadata(raw, "drop")).select(kept))
    assert files_by_directory(found, "statement_month").keys() == {
        "statement_month=2024-01", "statement_month=2024-02", "statement_month=__HIVE_DEFAULT_PARTITION__"
    }


def test_tables_store_fingerprints_in_half_their_size(spark, tmp_path):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"), (F.col("id") % 2).alias("p"))
    append_table(df, str(tmp_path / "a"))
    append_partitioned(df, str(tmp_path / "b"), "p")
    for name in "ab":
        assert file_sizes(spark, str(tmp_path / name)).agg(F.sum("file_size")).first()[0] < 0.7 * 64 * 20_000
