"""From statement files to the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import parse_statement_date, statement_month
from tillroll.functions.hashing import row_fingerprint
from tillroll.operators.charges import add_ingest_metadata, only_charges
from tillroll.operators.merge import (
    COPY,
    copy_key,
    insert_only_merge,
    number_copies,
    single_copies,
    split_known_rows,
)
from tillroll.operators.normalize import normalize_statements
from tillroll.operators.quality import QualityResult, run_quality
from tillroll.operators.recurring import counted_amounts, detect_recurring
from tillroll.operators.rule_join import categorize_by_table
from tillroll.operators.spend import (
    monthly_from_totals,
    stability_from_totals,
    totals_from_amounts,
)
from tillroll.plans.rejects import SOURCE_FILE, Rejects, set_aside
from tillroll.rules import QualityRule
from tillroll.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tillroll.sources.scratch import scratch_path
from tillroll.sources.statements import read_statements
from tillroll.sources.tables import (
    append_partitioned,
    append_table,
    delete_table,
    find_table,
    read_table,
    replace_table,
)

FINGERPRINT = "_row_hash"
MONTH = "statement_month"
BRONZE_MONTH = "_month"


def bronze_rows(raw: DataFrame, source: str, *, skip_nulls: bool = False) -> DataFrame:
    """Charges of a file scan, batch or stream, with their ingest metadata."""
    named = add_ingest_metadata(
        raw, source, source_file=F.col("_metadata.file_path"), skip_nulls=skip_nulls
    )
    return only_charges(named)


def ingest_statements(
    spark: SparkSession,
    source: str,
    bronze: str,
    *,
    glob: str = "*.csv",
    options: Mapping[str, str] | None = None,
    dedupe_within_batch: bool = False,
    keep_copies: bool = False,
    by_month: bool = True,
    skip_nulls: bool = False,
    rejects: Rejects | None = None,
) -> None:
    """Merge the charges of all statement files below ``source`` into the bronze table.

    Running it again, or on a directory that holds files ingested before, adds only new rows. By
    default all copies of a new row stay. ``dedupe_within_batch`` keeps a fingerprint once;
    ``keep_copies`` gives each copy within a file a key of its own, so that a merge which died half
    way is completed by running it again, whatever it had committed.

    With ``by_month`` the table has a directory per month of the transaction date (``_month``), and
    only the months of the new files are searched; the fingerprint covers the date. A table that
    was begun without goes on without.

    A line that does not parse fails the job and nothing is merged. With ``rejects`` such lines go to a
    table of their own and the others are merged.
    """
    raw = read_statements(spark, source, glob=glob, options=options, keep_rejected=rejects is not None)
    merging = {"dedupe": dedupe_within_batch, "keep_copies": keep_copies, "by_month": by_month}
    if rejects is None and (keep_copies or dedupe_within_batch):
        merge_bronze(bronze_rows(raw, source, skip_nulls=skip_nulls), bronze, **merging)
    elif rejects is None:

        def named(rows: DataFrame) -> DataFrame:
            return with_metadata(rows, source, skip_nulls)

        files = raw.select("*", F.col("_metadata.file_path").alias("_source_file"))
        merge_bronze(only_charges(files), bronze, derive=named, **merging)
    else:
        merge_accepted(with_source_file(raw), source, bronze, rejects, skip_nulls=skip_nulls, **merging)


def with_metadata(rows: DataFrame, source: str, skip_nulls: bool) -> DataFrame:
    """Bronze rows from raw ones that have their file's name; a column of the month stays, as the last.

    A copy that has a number, which stays too, gets a fingerprint of its own.
    """
    named = rows.withColumnRenamed("_source_file", "_file")
    named = add_ingest_metadata(named, source, source_file=F.col("_file"), skip_nulls=skip_nulls)
    if COPY in rows.columns:
        named = named.withColumn(FINGERPRINT, copy_key(FINGERPRINT))
    return named.select(*BRONZE_SCHEMA.names, *(name for name in rows.columns if name in (COPY, BRONZE_MONTH)))


def with_source_file(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def merge_accepted(
    parsed: DataFrame, source: str, bronze: str, rejects: Rejects, *, skip_nulls: bool, **merging: bool
) -> None:
    """Set the rejected lines of ``parsed`` aside and merge its other rows into the bronze table."""
    accepted, place = set_aside(parsed, source, rejects)
    try:
        file = F.col("_file")
        named = add_ingest_metadata(
            accepted.withColumnRenamed(SOURCE_FILE, "_file"), source, source_file=file, skip_nulls=skip_nulls
        )
        merge_bronze(only_charges(named.drop(file)), bronze, **merging)
    finally:
        delete_table(parsed.sparkSession, place)


def merge_bronze(
    rows: DataFrame,
    bronze: str,
    *,
    dedupe: bool,
    keep_copies: bool,
    by_month: bool,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    key: Column | None = None,
) -> None:
    """Merge bronze rows, or what ``derive`` makes them from, into their table; see :func:`ingest_statements`.

    With ``key``, the fingerprint of a row that ``derive`` takes, such rows are made single before they are
    derived. The first ones of a table are then staged: a statement's shuffle files can be removed when it
    ends, and those of the next one need not lie beside them.
    """
    spark, carried, place = rows.sparkSession, (), None
    if key is not None and (keep_copies or dedupe):
        rows, carried, dedupe = single_copies(rows, key, keep_copies=keep_copies), (COPY,), False
        place = scratch_path(spark, "single") if find_table(spark, bronze) is None else None
    elif keep_copies:
        rows, dedupe = number_copies(rows, FINGERPRINT), True
    if by_month:
        day = parse_statement_date(F.col("Transaction Date"))
        rows = rows.withColumn(BRONZE_MONTH, F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none")))
    month = BRONZE_MONTH if by_month else None
    try:
        if place is not None:
            append_table(rows, place)
            rows = read_table(spark, place, rows.schema)
        insert_only_merge(
            spark,
            rows,
            bronze,
            FINGERPRINT,
            partition_by=month,
            prune_by=month,
            dedupe_within_batch=dedupe,
            derive=derive,
            carried=carried,
        )
    finally:
        if place is not None:
            delete_table(spark, place)


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    *,
    gate_log: str | None = None,
    gate_rules: Sequence[QualityRule] | None = None,
    search_all_months: bool = False,
    ingested_since: datetime | None = None,
    merchant_rules: DataFrame | None = None,
    **normalize_options,
) -> list[QualityResult] | None:
    """Append the bronze rows that the silver table lacks, typed and categorised, by month.

    The fingerprint covers the transaction date, and the date gives the month, so the silver table
    is searched only in the months that the new rows span. Where earlier rows were put into months
    by other rules (another cut day or date format), ask to ``search_all_months``.

    ``ingested_since`` leaves out bronze rows that were ingested before, which an earlier build has
    published; the build then reads, compares and searches the months of the new rows only. What it
    lets through a second time is still found by its fingerprint.

    ``merchant_rules`` is a rule table, such as the one at ``StatementPaths.merchant_rules``; it takes
    the place of the rules in ``normalize_options``. With ``gate_log`` the new rows are checked before
    any of them is published; a failed ERROR rule raises and leaves the table as it is.

    Rows are compared, staged and dealt out to the months as they are in bronze, and typed where they are
    checked and written. Only those that a join has let through are staged for the check; the others are read
    twice from the files of bronze that were listed at first. With ``merchant_rules`` typed rows are staged.
    """
    rows = read_table(spark, bronze, BRONZE_SCHEMA)
    if ingested_since is not None:
        rows = rows.where(F.col("_ingest_ts") >= F.lit(ingested_since))
    dates = {"fmt": v for k, v in normalize_options.items() if k == "date_format"}
    cut = {k: v for k, v in normalize_options.items() if k == "cut_day"}
    month = statement_month(parse_statement_date(F.col("Transaction Date"), **dates), **cut)
    certain, joined = split_known_rows(
        spark,
        rows.withColumn(MONTH, month),
        silver,
        key=FINGERPRINT,
        prune_by=None if search_all_months else MONTH,
        schema=SILVER_SCHEMA,
    )

    def typed(fresh: DataFrame) -> DataFrame:
        return normalize_statements(fresh.drop(MONTH), **normalize_options)

    def publish(fresh: DataFrame) -> None:
        append_partitioned(_hide_fingerprint(fresh), silver, MONTH, derive=lambda r: typed(_show_fingerprint(r)))

    if merchant_rules is not None:
        fresh = typed(certain if joined is None else certain.unionByName(joined))
        mapped = {k: v for k, v in normalize_options.items() if k == "mapping"}
        certain, joined = None, categorize_by_table(fresh.drop("category"), merchant_rules, **mapped).select(*fresh.columns)
        typed, publish = (lambda fresh: fresh), (lambda fresh: append_partitioned(fresh, silver, MONTH))

    staged, results = scratch_path(spark, "silver-staged"), None
    try:
        if gate_log is not None and joined is not None:
            append_table(joined, staged)
            joined = read_table(spark, staged, joined.schema)
        fresh = reduce(DataFrame.unionByName, [part for part in (certain, joined) if part is not None])
        if gate_log is not None:
            results = run_quality(spark, typed(fresh), gate_log, gate_rules)
        publish(fresh)
    finally:
        delete_table(spark, staged)
    return results


def _hide_fingerprint(rows: DataFrame) -> DataFrame:
    """Bronze rows with a mark for a fingerprint that follows from the row, which is then not shuffled."""
    key = F.col(FINGERPRINT)
    return rows.withColumn(FINGERPRINT, F.when(key == row_fingerprint(), "=").otherwise(F.concat(F.lit("!"), key)))


def _show_fingerprint(rows: DataFrame) -> DataFrame:
    key = F.col(FINGERPRINT)
    return rows.withColumn(FINGERPRINT, F.when(key == "=", row_fingerprint()).otherwise(F.substr(key, F.lit(2))))


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    *,
    stability: Mapping[str, float] | None = None,
    recurring: Mapping[str, object] | None = None,
) -> None:
    """Write monthly spend, spend stability and recurring charges anew.

    ``stability`` and ``recurring`` are thresholds and options of
    :func:`~tillroll.operators.fixed_vs_variable` and :func:`~tillroll.operators.detect_recurring`.

    The transactions are read once. All three tables come from how often each merchant charged each
    amount in each month, which is staged in the shared folder while they are written.
    """
    path = scratch_path(spark, "counted-amounts")
    try:
        append_table(counted_amounts(read_table(spark, silver, SILVER_SCHEMA)), path)
        publish_gold(
            read_table(spark, path), gold, lambda: read_table(spark, silver, SILVER_SCHEMA), stability, recurring
        )
    finally:
        delete_table(spark, path)


def publish_gold(
    amounts: DataFrame,
    gold: str,
    transactions: Callable[[], DataFrame],
    stability: Mapping[str, float] | None,
    recurring: Mapping[str, object] | None,
) -> None:
    """Write the gold tables from stored counted amounts; see :func:`build_gold`.

    ``transactions`` is read only for a sketch of the median, which is of the charges themselves.
    """
    totals = totals_from_amounts(amounts).persist()
    try:
        replace_table(monthly_from_totals(totals), f"{gold}/monthly_by_category")
        replace_table(stability_from_totals(totals, **(stability or {})), f"{gold}/fixed_vs_variable")
    finally:
        totals.unpersist()
    options = dict(recurring or {})
    rows = transactions() if options.get("median_accuracy") is not None else amounts
    replace_table(detect_recurring(rows, amounts=amounts, **options), f"{gold}/recurring")
