"""

Every query runs over whole tables. The statement feed of most of them is line items joined to
parts (see ``tillroll.sources.feeds``); others run on orders, events, customers and documents.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import (
    categorize,
    keyword_category,
    mapped_category,
    normalize_text,
    parse_statement_date,
    row_fingerprint,
    statement_month,
)
from tillroll.operators import (
    KeyHistory,
    add_ingest_metadata,
    categorize_by_table,
    compact_table,
    detect_recurring,
    drop_known_rows,
    fixed_vs_variable,
    insert_only_merge,
    month_slice,
    monthly_by_category,
    normalize_statements,
    only_charges,
    quality_report,
    run_quality,
    source_files,
    top_recurring,
)
from tillroll.operators.quality import QualityError
from tillroll.plans import (
    Rejects,
    StatementPaths,
    build_gold,
    build_silver,
    ingest_statements,
    refresh_gold,
)
from tillroll.rules import (
    KEYWORD_RULES,
    SEED_RULES,
    SOURCE_CATEGORY_MAP,
    QualityRule,
    rule_table,
    silver_quality_rules,
)
from tillroll.schemas import RAW_COLUMNS, SILVER_SCHEMA
from tillroll.sources import (
    append_partitioned,
    append_table,
    count_per_value,
    event_spend,
    lineitem_feed,
    order_spend,
    read_statements,
    read_table,
    scratch_path,
)
from tillroll.streaming import ingest_statements_stream

Query = Callable[[SparkSession, str], DataFrame]

# Rules for the feed: merchants are named "<adjective> <noun> #<part>". Two nouns have no rule, so
# that the category of the source and the fallback come into play; one keyword holds another.
FEED_RULES = [
    ("red ring", "Jewels"),
    ("ring", "Hardware"),
    ("bolt", "Hardware"),
    ("widget", "Gadgets"),
    ("gizmo", "Gadgets"),
    ("gear", "Machines"),
    ("plate", "Kitchen"),
]
FEED_MAP = {"ECONOMY": "Budget", "STANDARD": "Regular", "PROMO": "Offers"}
FEED_CATEGORIES = ["Jewels", "Hardware", "Gadgets", "Machines", "Kitchen", "Budget", "Offers"]
FEED_NAME = "lineitem-feed"
# Two drops of statements that share a year.
SECOND_DROP_FROM = "1998-01-01"
FIRST_DROP_UNTIL = "1999-01-01"
FIRST_ORDERS = "1992-09-01"
REPORT_DAY = date(1999, 1, 1)
BRONZE_OUT = [*RAW_COLUMNS, "_batch_id", "_row_hash"]
SILVER_OUT = [
    name for name in SILVER_SCHEMA.fieldNames() if name not in ("_ingest_ts", "_source_file", "_silver_ts")
]


def _training_data():
    """The queries of the training-data operators, or None where that subpackage is not installed."""
    try:
        return importlib.import_module("tillroll.llm.queries")
    except ModuleNotFoundError as missing:
        name = missing.name or ""
        if name != "corpus_pipeline" and not name.startswith("tillroll.llm"):
            raise
        return None


# ------------------------------------------------------------------------------------ inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_feed(_table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "part"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_ingest_metadata(_feed(spark, sf_dir), FEED_NAME)


def _typed(feed: DataFrame) -> DataFrame:
    return normalize_statements(add_ingest_metadata(feed, FEED_NAME), rules=FEED_RULES, mapping=FEED_MAP)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed feed with its credits, so that the reports have some to leave out."""
    return _typed(_feed(spark, sf_dir))


def _append_silver(feed: DataFrame, path: str) -> None:
    """The typed feed appended by month; rows are typed where they are written."""
    month = statement_month(parse_statement_date(F.col("Transaction Date")))
    append_partitioned(feed, path, "statement_month", deal_by=month, derive=_typed)


def _spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports need of the typed feed."""
    return _silver(spark, sf_dir).select(
        "description_norm", "category", "amount", "statement_month", "is_credit"
    )


def _drops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    day = parse_statement_date(F.col("Transaction Date"))
    rows = only_charges(_bronze(spark, sf_dir))
    return rows.where(day < FIRST_DROP_UNTIL), rows.where(day >= SECOND_DROP_FROM)


def _drop_files(spark: SparkSession, sf_dir: str, path: str, which: int) -> None:
    rows = _drops(spark, sf_dir)[which].select(*RAW_COLUMNS)
    rows.write.mode("append").option("header", "true").csv(path)


# ----------------------------------------------------------------------------------- queries


def _row_fingerprint(spark, sf_dir):
    return _feed(spark, sf_dir).select("Description", "Amount", row_fingerprint().alias("_row_hash"))


def _row_fingerprint_skip_nulls(spark, sf_dir):
    return _feed(spark, sf_dir).select(
        "Description", "Amount", row_fingerprint(skip_nulls=True).alias("_row_hash")
    )


def _charges_only(spark, sf_dir):
    return only_charges(_bronze(spark, sf_dir)).select(*BRONZE_OUT)


def _statement_files(spark, sf_dir):
    path = scratch_path(spark, "statements")
    _feed(spark, sf_dir).write.option("header", "true").csv(path)
    return read_statements(spark, path)


def _text_normalize(spark, sf_dir):
    return _feed(spark, sf_dir).select(
        "Description", normalize_text(F.col("Description")).alias("description_norm")
    )


def _text_normalize_documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(
        "doc_id", normalize_text(F.col("text")).alias("text_norm")
    )


def _text_normalize_turns(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", normalize_text(F.col("text")).alias("text_norm")
    )


def _categorize_rules(spark, sf_dir):
    return _silver(spark, sf_dir).select("description_norm", "chase_category", "category")


def _categorize_documents(spark, sf_dir):
    """The default rules on free text."""
    return _table(spark, sf_dir, "documents").select(
        "doc_id", categorize(normalize_text(F.col("text")), F.col("source")).alias("category")
    )


def _keyword_hits(spark, sf_dir):
    rules = [("gear", "Machines"), ("bolt #1", "First bolts"), ("bolt", "Hardware")]
    return _feed(spark, sf_dir).select(
        "Description",
        keyword_category(normalize_text(F.col("Description")), rules).alias("keyword_category"),
        mapped_category(F.concat(F.lit("\t "), "Category", F.lit(" \n")), FEED_MAP).alias(
            "mapped_category"
        ),
    )


def _categorize_rule_table(spark, sf_dir):
    typed = _silver(spark, sf_dir).drop("category")
    return categorize_by_table(typed, rule_table(spark, FEED_RULES), mapping=FEED_MAP).select(
        "description_norm", "chase_category", "category"
    )


def _categorize_seed_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        normalize_text(F.col("text")).alias("description_norm"),
        F.col("source").alias("chase_category"),
    )
    return categorize_by_table(docs, rule_table(spark, SEED_RULES)).select("doc_id", "category")


def _categorize_part_rules(spark, sf_dir):
    """A rule per part; the names of some parts hold those of others."""
    part = _table(spark, sf_dir, "part")
    rules = part.select(
        F.col("p_partkey").alias("priority"),
        F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("keyword"),
        F.col("p_brand").alias("category"),
    )
    # parts are as many as rules: a small file of them can be too many rows for the driver to broadcast
    feed = lineitem_feed(_table(spark, sf_dir, "lineitem"), part.hint("merge"))
    typed = _typed(feed).select("description_norm", "chase_category", "amount")
    return categorize_by_table(typed, rules, mapping=FEED_MAP, max_inline_rules=0)


def _statement_month(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        statement_month(day).alias("statement_month"),
        statement_month(day, 15).alias("mid_month"),
    )


def _silver_typed(spark, sf_dir):
    return _silver(spark, sf_dir).select(*SILVER_OUT)


def _merge(spark, sf_dir, *, repeat=False, **options):
    path = scratch_path(spark, "merge")
    first, second = _drops(spark, sf_dir)
    for batch in [first, second, second] if repeat else [first, second]:
        insert_only_merge(spark, batch, path, "_row_hash", **options)
    return read_table(spark, path).select(*BRONZE_OUT)


def _merge_insert_only(spark, sf_dir):
    return _merge(spark, sf_dir)


def _merge_idempotent(spark, sf_dir):
    return _merge(spark, sf_dir, repeat=True)


def _merge_dedupe(spark, sf_dir):
    return _merge(spark, sf_dir, dedupe_within_batch=True)


def _merge_key_history(spark, sf_dir):
    """Both drops and the second once more, by month, with filters of the keys kept beside the table."""
    path, history = scratch_path(spark, "merge"), KeyHistory(scratch_path(spark, "key-history"), 1 << 17)
    first, second = _drops(spark, sf_dir)
    for batch in (first, second, second):
        rows = batch.withColumn("month", F.date_format(parse_statement_date(F.col("Transaction Date")), "yyyy-MM"))
        insert_only_merge(spark, rows, path, "_row_hash", partition_by="month", prune_by="month", history=history)
    return read_table(spark, path).select(*BRONZE_OUT)


def _merge_hot_keys(spark, sf_dir):
    """Orders keyed by customer: all orders of customers that were not in an earlier drop.

    Keys with eight orders in a drop count as hot, so that both ways of joining are taken.
    """
    path = scratch_path(spark, "merge-hot")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = F.col("o_orderdate").cast("date")
    for batch in (orders.where(day < FIRST_ORDERS), orders.where(day >= FIRST_ORDERS)):
        insert_only_merge(spark, batch, path, "o_custkey", hot_key_rows=8)
    return read_table(spark, path)


def _dedup_anti_join(spark, sf_dir):
    path = scratch_path(spark, "dedup")
    known = normalize_statements(_drops(spark, sf_dir)[0], rules=FEED_RULES, mapping=FEED_MAP)
    append_partitioned(known, path, "statement_month")
    return drop_known_rows(
        spark, _silver(spark, sf_dir), path, prune_by="statement_month", schema=SILVER_SCHEMA
    ).select(*SILVER_OUT)


def _month_counts(spark, sf_dir):
    return count_per_value(_silver(spark, sf_dir), "statement_month")


def _partitioned_silver(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "silver")
    _append_silver(_feed(spark, sf_dir), path)
    return read_table(spark, path, SILVER_SCHEMA)


def _partitioned_append(spark, sf_dir):
    return _partitioned_silver(spark, sf_dir).select(*SILVER_OUT)


def _month_slice(spark, sf_dir):
    return month_slice(_partitioned_silver(spark, sf_dir), "1997-03", "Hardware").select(*SILVER_OUT)


def _monthly_by_category(spark, sf_dir):
    return monthly_by_category(_spend(spark, sf_dir))


def _fixed_vs_variable(spark, sf_dir):
    return fixed_vs_variable(_spend(spark, sf_dir))


def _recurring_charges(spark, sf_dir):
    return detect_recurring(_spend(spark, sf_dir))


def _recurring_thresholds(spark, sf_dir):
    """Thresholds at which all three kinds occur."""
    return detect_recurring(
        _spend(spark, sf_dir), min_months=16, amount_cv_threshold=0.6, monthly_from=20
    )


def _steady_orders(spark, sf_dir):
    """Orders that bill two of three customers the same amount each time."""
    spend = order_spend(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"))
    number = F.substring_index("description_norm", "#", -1).cast("int")
    steady = F.when(number % 3 == 0, F.col("amount")).otherwise((number % 90 + 10).cast("double"))
    return spend.withColumn("amount", steady)


def _recurring_defaults(spark, sf_dir):
    """Default thresholds; merchants of all three kinds occur."""
    return detect_recurring(_steady_orders(spark, sf_dir))


def _default_rules(spark, sf_dir):
    """The default rules on merchants of whom each default keyword and source category names some."""
    words = F.array(*[F.lit(keyword) for keyword, _ in KEYWORD_RULES], F.lit("NO RULE"))
    sources = F.array(*map(F.lit, SOURCE_CATEGORY_MAP), F.lit("Other"))
    part = _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("The "), F.get(words, F.expr(f"int(p_partkey % {len(KEYWORD_RULES) + 1})")), F.lit(" #"), "p_partkey").alias("merchant"),
        F.get(sources, F.expr(f"int((p_partkey div 7) % {len(SOURCE_CATEGORY_MAP) + 1})")).alias("source"),
    )
    return part.select("p_partkey", categorize(normalize_text(F.col("merchant")), F.col("source")).alias("category"))


def _recurring_top(spark, sf_dir):
    return top_recurring(detect_recurring(_spend(spark, sf_dir)), 25)


def _months_seen(spark, sf_dir):
    return detect_recurring(_spend(spark, sf_dir), with_months=True).select(
        "description_norm",
        "category",
        "occurrence_months",
        F.concat_ws(",", "months_seen").alias("months_seen"),
    )


def _recurring_customers(spark, sf_dir):
    spend = order_spend(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"))
    return detect_recurring(spend, amount_cv_threshold=0.5, monthly_from=3)


def _monthly_orders(spark, sf_dir):
    return monthly_by_category(
        order_spend(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"))
    )


def _events_daily(spark, sf_dir):
    return monthly_by_category(event_spend(_table(spark, sf_dir, "events")))


def _events_daily_stability(spark, sf_dir):
    return fixed_vs_variable(event_spend(_table(spark, sf_dir, "events")))


def _quality_report(spark, sf_dir):
    rules = silver_quality_rules(FEED_CATEGORIES, today=REPORT_DAY)
    return quality_report(_silver(spark, sf_dir), rules)


def _labelled(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(_table(spark, sf_dir, "labels"), "doc_id", "left")


LABEL_RULES = [
    QualityRule("good", "quality = 1", "ERROR"),
    QualityRule("clean", "toxic = 0", "WARN"),
    QualityRule("known_language", "lang IN ('en', 'de', 'fr')", "WARN"),
    QualityRule("long_enough", "n_chars >= 200", "WARN"),
]


def _quality_labels(spark, sf_dir):
    return quality_report(_labelled(spark, sf_dir), LABEL_RULES)


def _quality_labels_strict(spark, sf_dir):
    return quality_report(_labelled(spark, sf_dir), LABEL_RULES, null_is_failure=True)


def _quality_log(spark, sf_dir):
    """Two runs into one log; the failed ERROR rule raises after its run was logged."""
    path = scratch_path(spark, "quality-log")
    for null_is_failure in (False, True):
        try:
            run_quality(
                spark, _labelled(spark, sf_dir), path, LABEL_RULES, null_is_failure=null_is_failure
            )
        except QualityError:
            pass
    return read_table(spark, path).drop("checked_at")


def _source_files(spark, sf_dir):
    """Name and rows of the files behind three tables."""
    found = []
    for name in ("lineitem", "orders", "part"):
        rows = _table(spark, sf_dir, name).select(F.col("_metadata.file_path").alias("_source_file"))
        counts = rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("row_count"))
        found.append(source_files(rows).join(counts, "_source_file"))
    file = F.element_at(F.split("_source_file", "/"), -1).alias("file")
    return reduce(DataFrame.unionByName, found).select(file, "row_count")


def _ingested(spark, sf_dir) -> str:
    """Both drops ingested from files, with the second run seeing the files of the first again."""
    drop, bronze = scratch_path(spark, "drop"), scratch_path(spark, "bronze")
    for which in (0, 1):
        _drop_files(spark, sf_dir, drop, which)
        ingest_statements(spark, drop, bronze)
    return bronze


def _batch_ingest(spark, sf_dir):
    return read_table(spark, _ingested(spark, sf_dir)).select(*RAW_COLUMNS, "_row_hash")


def _ingest_rejects(spark, sf_dir):
    """Files in which the amount of every tenth part is no number: rows merged and lines set aside."""
    drop, bronze, rejects = (scratch_path(spark, label) for label in ("drop", "bronze", "rejects"))
    part = F.substring_index("Description", "#", -1).cast("int")
    amount = F.when(part % 10 == 0, F.lit("n/a")).otherwise(F.col("Amount").cast("string"))
    files = _feed(spark, sf_dir).withColumn("Amount", amount).select(*RAW_COLUMNS)
    files.write.option("header", "true").csv(drop)
    ingest_statements(spark, drop, bronze, rejects=Rejects(rejects))
    fields = F.split("line", ",")
    named = [fields[i].alias(name) for i, name in enumerate(RAW_COLUMNS[:5])]
    # a line is stored once per file, and how rows fall into files is not the query's matter
    lines = read_table(spark, rejects).select("line").distinct().select(*named, F.lit(None).cast("double").alias("Amount"))
    rows = read_table(spark, bronze).select(*RAW_COLUMNS[:6])
    return rows.withColumn("rejected", F.lit(False)).unionByName(lines.withColumn("rejected", F.lit(True)))


def _built_silver(spark, sf_dir, stored_rules=False) -> str:
    """Silver built after each drop, with listed rules or those of a stored rule table."""
    paths = StatementPaths.under(scratch_path(spark, "build"), scratch_path(spark, "drop"))
    options = {"rules": FEED_RULES}
    if stored_rules:
        append_table(rule_table(spark, FEED_RULES), paths.merchant_rules)
        options = {"merchant_rules": read_table(spark, paths.merchant_rules)}
    for which in (0, 1):
        _drop_files(spark, sf_dir, paths.source, which)
        ingest_statements(spark, paths.source, paths.bronze)
        build_silver(spark, paths.bronze, paths.silver, gate_log=paths.quality_log, mapping=FEED_MAP, **options)
    return paths.silver


def _silver_build(spark, sf_dir, stored_rules=False):
    return read_table(spark, _built_silver(spark, sf_dir, stored_rules), SILVER_SCHEMA).select(
        *(name for name in SILVER_OUT if name != "_batch_id")
    )


def _silver_build_rule_table(spark, sf_dir):
    return _silver_build(spark, sf_dir, stored_rules=True)


def _gold(name: str) -> Query:
    def query(spark, sf_dir):
        silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
        _append_silver(_feed(spark, sf_dir), silver)
        build_gold(spark, silver, gold)
        return read_table(spark, f"{gold}/{name}")

    return query


def _gold_by_month(name: str) -> Query:
    """Gold tables refreshed after each of two appends to silver, which share a year of months."""

    def query(spark, sf_dir):
        silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
        rows, day = _feed(spark, sf_dir), parse_statement_date(F.col("Transaction Date"))
        late = F.coalesce(day >= SECOND_DROP_FROM, F.lit(False))
        recent = late & ((day >= FIRST_DROP_UNTIL) | (F.dayofmonth(day) > 14))
        for drop in (rows.where(~recent), rows.where(recent)):
            _append_silver(drop, silver)
            refresh_gold(spark, silver, gold)
        return read_table(spark, f"{gold}/{name}")

    return query


def _compact_preserves_rows(spark, sf_dir):
    table, out = scratch_path(spark, "scattered"), scratch_path(spark, "compact")
    category = categorize(normalize_text(F.col("Description")), F.col("Category"), FEED_RULES, FEED_MAP)
    append_partitioned(_feed(spark, sf_dir), table, "category", deal_by=category, derive=_typed)
    compact_table(spark, table, out, partition_by="category", cluster_by=["statement_month", "amount"])
    return read_table(spark, out).select(*SILVER_OUT)


def _compact_plain(spark, sf_dir):
    table, out = scratch_path(spark, "scattered"), scratch_path(spark, "compact")
    events = _table(spark, sf_dir, "events")
    append_table(events.repartition(16, "user_id"), table)
    compact_table(spark, table, out)
    return read_table(spark, out)


def _compact_interleaved(spark, sf_dir):
    """Order lines clustered by date and price alike."""
    out = scratch_path(spark, "compact")
    columns = ["l_shipdate", "l_extendedprice"]
    compact_table(spark, f"{sf_dir}/lineitem.parquet", out, cluster_by=columns, interleave=True)
    return read_table(spark, out)


def _stream(spark, sf_dir, drops, **options):
    drop, bronze = scratch_path(spark, "drop"), scratch_path(spark, "bronze")
    checkpoint = scratch_path(spark, "checkpoint")
    for which in drops:
        _drop_files(spark, sf_dir, drop, which)
        ingest_statements_stream(spark, drop, bronze, checkpoint, **options).awaitTermination()
    return read_table(spark, bronze).select(*RAW_COLUMNS, "_row_hash")


def _stream_ingest(spark, sf_dir):
    """All drops in one run; one row of each is kept, however files fall into micro-batches."""
    drop, bronze = scratch_path(spark, "drop"), scratch_path(spark, "bronze")
    for which in (0, 1):
        _drop_files(spark, sf_dir, drop, which)
    ingest_statements_stream(
        spark,
        drop,
        bronze,
        scratch_path(spark, "checkpoint"),
    ).awaitTermination()
    return read_table(spark, bronze).select(*RAW_COLUMNS, "_row_hash")


def _stream_two_drops(spark, sf_dir):
    return _stream(spark, sf_dir, (0, 1))


def _stream_caps(spark, sf_dir):
    """The same files, taken one, seven and a thousand at a time, with and without copies."""
    drop, results = scratch_path(spark, "drop"), []
    for which in (0, 1):
        rows = _drops(spark, sf_dir)[which].select(*RAW_COLUMNS)
        rows.repartition(4, "Transaction Date").write.mode("append").option("header", "true").csv(drop)
    for cap in (1, 7, 1000):
        for keep in (False, True):
            bronze = scratch_path(spark, "bronze")
            ingest_statements_stream(
                spark, drop, bronze, scratch_path(spark, "checkpoint"), max_files_per_trigger=cap, keep_copies=keep
            ).awaitTermination()
            labels = [F.lit(cap).alias("cap"), F.lit(keep).alias("keep_copies")]
            results.append(read_table(spark, bronze).select(*labels, *RAW_COLUMNS))
    return reduce(DataFrame.unionByName, results)


def _compact_codes(spark, sf_dir):
    """Codes that look like numbers and NULLs, as directories, compacted by other columns."""
    table, out = scratch_path(spark, "codes"), scratch_path(spark, "compact")
    codes = _table(spark, sf_dir, "events").select(
        "event_id", F.expr("element_at(array('01', '1', 'A7', NULL), CAST(event_id % 4 AS INT) + 1)").alias("code")
    )
    schema = codes.schema
    append_partitioned(codes, table, "code")
    compact_table(spark, table, out, partition_by="code", cluster_by=["event_id"])
    return read_table(spark, out, schema)


def queries() -> dict[str, Query]:
    """Each takes a session and the folder of the tables and returns a DataFrame."""
    more = _training_data()
    return _statement_queries() | (more.QUERIES if more else {})


def _statement_queries() -> dict[str, Query]:
    return {
        "row_fingerprint": _row_fingerprint,
        "row_fingerprint_skip_nulls": _row_fingerprint_skip_nulls,
        "charges_only": _charges_only,
        "statement_files": _statement_files,
        "text_normalize": _text_normalize,
        "text_normalize_documents": _text_normalize_documents,
        "text_normalize_turns": _text_normalize_turns,
        "categorize_rules": _categorize_rules,
        "categorize_documents": _categorize_documents,
        "keyword_hits": _keyword_hits,
        "categorize_rule_table": _categorize_rule_table,
        "categorize_seed_rules": _categorize_seed_rules,
        "categorize_part_rules": _categorize_part_rules,
        "statement_month": _statement_month,
        "silver_typed": _silver_typed,
        "merge_insert_only": _merge_insert_only,
        "merge_idempotent": _merge_idempotent,
        "merge_dedupe": _merge_dedupe,
        "merge_hot_keys": _merge_hot_keys,
        "merge_key_history": _merge_key_history,
        "dedup_anti_join": _dedup_anti_join,
        "month_counts": _month_counts,
        "partitioned_append": _partitioned_append,
        "month_slice": _month_slice,
        "monthly_by_category": _monthly_by_category,
        "fixed_vs_variable": _fixed_vs_variable,
        "recurring_charges": _recurring_charges,
        "recurring_thresholds": _recurring_thresholds,
        "recurring_defaults": _recurring_defaults,
        "default_rules": _default_rules,
        "recurring_top": _recurring_top,
        "months_seen": _months_seen,
        "recurring_customers": _recurring_customers,
        "monthly_orders": _monthly_orders,
        "events_daily": _events_daily,
        "events_daily_stability": _events_daily_stability,
        "quality_report": _quality_report,
        "quality_labels": _quality_labels,
        "quality_labels_strict": _quality_labels_strict,
        "quality_log": _quality_log,
        "source_files": _source_files,
        "batch_ingest": _batch_ingest,
        "ingest_rejects": _ingest_rejects,
        "silver_build": _silver_build,
        "silver_build_rule_table": _silver_build_rule_table,
        "gold_refresh": _gold("monthly_by_category"),
        "gold_stability": _gold("fixed_vs_variable"),
        "gold_recurring": _gold("recurring"),
        "gold_refresh_by_month": _gold_by_month("monthly_by_category"),
        "gold_stability_by_month": _gold_by_month("fixed_vs_variable"),
        "gold_recurring_by_month": _gold_by_month("recurring"),
        "compact_preserves_rows": _compact_preserves_rows,
        "compact_plain": _compact_plain,
        "compact_interleaved": _compact_interleaved,
        "stream_ingest": _stream_ingest,
        "stream_two_drops": _stream_two_drops,
        "stream_caps": _stream_caps,
        "compact_codes": _compact_codes,
    }



# ------------------------------------------------------------------------------------ oracles


def _norm(text: str) -> str:
    """Upper-casing there keeps a sharp s as one letter; here it is two, as in Unicode."""
    upper = f"upper(replace(coalesce({text}, ''), 'ß', 'SS'))"
    return (
        f"trim(regexp_replace(regexp_replace({upper}, '[''‘’`]', '', 'g'), '[^A-Z0-9]+', ' ', 'g'))"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(text: str, rules: list[tuple[str, str]]) -> str:
    """The first rule whose keyword, already in normal form, is in the text."""
    arms = " ".join(f"WHEN contains({text}, {_quoted(k)}) THEN {_quoted(c)}" for k, c in rules)
    return f"CASE {arms} END"


def _lookup(text: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in mapping.items())
    return f"CASE {text} {arms} END"


def _month(day: str, cut: int = 29) -> str:
    rolled = f"strftime(date_trunc('month', {day}) + INTERVAL 1 MONTH, '%Y-%m')"
    return f"CASE WHEN day({day}) >= {cut} THEN {rolled} ELSE strftime({day}, '%Y-%m') END"


def _round(number: str, digits: int) -> str:
    """Round half up on the decimal digits of a double; DuckDB would round its binary value."""
    exact = f"CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(round({exact}, {digits}) AS DOUBLE)"


_FEED_KEYWORDS = [(keyword.upper(), category) for keyword, category in FEED_RULES]
_RAW = ", ".join(f'"{name}"' for name in RAW_COLUMNS)
_RAW_KEYS = ", ".join(f'"{name}"' for name in RAW_COLUMNS[:5])
_HASH = (
    "sha256(concat_ws('|', "
    + ", ".join(f"coalesce(CAST(\"{name}\" AS VARCHAR), '')" for name in RAW_COLUMNS)
    + "))"
)
_HASH_SKIP = (
    "sha256(concat_ws('|', "
    + ", ".join(f'CAST("{name}" AS VARCHAR)' for name in RAW_COLUMNS)
    + "))"
)
_PAID = "CASE WHEN p_partkey % 4 = 0 THEN p_retailprice ELSE l_extendedprice END"
_CTES = {
    "feed": f"""
        SELECT strftime(CAST(l_shipdate AS DATE), '%m/%d/%Y') AS "Transaction Date",
               strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%m/%d/%Y') AS "Post Date",
               p_name || ' #' || p_partkey AS "Description",
               p_type AS "Category",
               CASE WHEN l_returnflag = 'R' THEN 'Payment' ELSE 'Sale' END AS "Type",
               CASE WHEN l_returnflag = 'R' THEN {_PAID} ELSE -({_PAID}) END AS "Amount",
               CAST(NULL AS VARCHAR) AS "Memo"
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "bronze": f"""
        SELECT *, sha1('{FEED_NAME}') AS _batch_id, {_HASH} AS _row_hash,
               CAST(strptime("Transaction Date", '%m/%d/%Y') AS DATE) AS day
        FROM feed""",
    "charges": """
        SELECT * FROM bronze WHERE "Amount" < 0""",
    "merged": f"""
        SELECT * FROM charges WHERE day < '{FIRST_DROP_UNTIL}'
        UNION ALL
        SELECT * FROM charges WHERE day >= '{SECOND_DROP_FROM}' AND _row_hash NOT IN
            (SELECT _row_hash FROM charges WHERE day < '{FIRST_DROP_UNTIL}')""",
    "typed": f"""
        SELECT "Description" AS description, "Category" AS chase_category,
               "Type" AS transaction_type, "Memo" AS memo, _batch_id, _row_hash,
               day AS trans_date,
               CAST(strptime("Post Date", '%m/%d/%Y') AS DATE) AS post_date,
               -"Amount" AS amount,
               {_norm('"Description"')} AS description_norm,
               {_month("day")} AS statement_month,
               -"Amount" < 0 AS is_credit
        FROM bronze""",
    "silver": f"""
        SELECT *, coalesce({_case("description_norm", _FEED_KEYWORDS)},
                           {_lookup("chase_category", FEED_MAP)}, 'Uncategorized') AS category
        FROM typed""",
    "order_spend": """
        SELECT upper(c_name) AS description_norm, o_orderpriority AS category,
               o_totalprice AS amount, strftime(o_orderdate, '%Y-%m') AS statement_month,
               o_orderstatus = 'F' AS is_credit
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "steady_orders": """
        SELECT upper(c_name) AS description_norm, o_orderpriority AS category,
               CASE WHEN CAST(split_part(c_name, '#', 2) AS INT) % 3 = 0 THEN o_totalprice
                    ELSE CAST(split_part(c_name, '#', 2) AS INT) % 90 + 10 END::DOUBLE AS amount,
               strftime(o_orderdate, '%Y-%m') AS statement_month, o_orderstatus = 'F' AS is_credit
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "event_spend": """
        SELECT 'USER ' || user_id AS description_norm, event_type AS category, value AS amount,
               strftime(ts, '%Y-%m-%d') AS statement_month, event_type = 'error' AS is_credit
        FROM events""",
    "labelled": """
        SELECT doc_id, lang, n_chars, quality, toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
}
_NEEDS = {
    "feed": [],
    "bronze": ["feed"],
    "charges": ["feed", "bronze"],
    "merged": ["feed", "bronze", "charges"],
    "typed": ["feed", "bronze"],
    "silver": ["feed", "bronze", "typed"],
}


def _with(source: str, body: str) -> str:
    names = [*_NEEDS.get(source, []), source]
    ctes = ",\n".join(f"{name} AS ({_CTES[name]}\n)" for name in names)
    return f"WITH {ctes}\n{body}"


def _monthly_sql(source: str) -> str:
    spend = _round("sum(amount)", 6)
    share = "total_spend / nullif(sum(total_spend) OVER (PARTITION BY statement_month), 0) * 100"
    change = "total_spend - lag(total_spend) OVER (PARTITION BY category ORDER BY statement_month)"
    return _with(
        source,
        f"""
        , m AS (SELECT statement_month, category, {_round(spend, 2)} AS total_spend,
                       count(*) AS tx_count, {_round(f"{spend} / count(amount)", 2)} AS avg_tx
                FROM {source} WHERE NOT is_credit AND statement_month IS NOT NULL GROUP BY ALL)
        SELECT *, {_round(share, 1)} AS pct_of_month, {_round(change, 2)} AS mom_delta
        FROM m""",
    )


def _stability_sql(source: str) -> str:
    mean = _round("sum(spend)", 6) + " / count(spend)"
    return _with(
        source,
        f"""
        , m AS (SELECT statement_month, category, {_round("sum(amount)", 6)} AS spend
                FROM {source} WHERE NOT is_credit GROUP BY ALL)
        , s AS (SELECT category, {_round(mean, 2)} AS avg_monthly,
                       {_round("stddev_samp(spend)", 2)} AS stddev_monthly,
                       count(*) AS sample_months
                FROM m GROUP BY ALL)
        , c AS (SELECT *, CASE WHEN avg_monthly > 0
                               THEN {_round("stddev_monthly / avg_monthly", 3)} END AS cv FROM s)
        SELECT *, CASE WHEN cv < 0.15 THEN 'FIXED' WHEN cv < 0.50 THEN 'VARIABLE'
                       ELSE 'DISCRETIONARY' END AS classification
        FROM c""",
    )


def _recurring_sql(
    source: str,
    min_months: int = 2,
    cv: float = 0.05,
    monthly_from: int = 6,
    select: str = "description_norm, category, median_amount, occurrence_months, is_recurring, "
    "recurrence_type, amount_cv",
    tail: str = "",
) -> str:
    return _with(
        source,
        f"""
        , g AS (SELECT description_norm, category,
                       {_round("quantile_disc(amount, 0.5)", 2)} AS median_amount,
                       {_round("stddev_samp(amount)", 2)} AS amount_stddev,
                       count(DISTINCT statement_month) AS occurrence_months,
                       array_to_string(list_sort(list(DISTINCT statement_month)), ',')
                           AS months_seen
                FROM {source} WHERE NOT is_credit GROUP BY ALL)
        , v AS (SELECT *, CASE WHEN median_amount > 0 THEN amount_stddev / median_amount END
                          AS amount_cv FROM g)
        , f AS (SELECT *, coalesce(occurrence_months >= {min_months} AND amount_cv < {cv}, false)
                          AS is_recurring FROM v)
        , r AS (SELECT *, CASE WHEN NOT is_recurring THEN 'IRREGULAR'
                               WHEN occurrence_months >= {monthly_from} THEN 'MONTHLY'
                               ELSE 'OCCASIONAL' END AS recurrence_type FROM f)
        SELECT {select} FROM r {tail}""",
    )


def _quality_sql(source: str, rules: list[tuple[str, str, str]], strict: bool = False) -> str:
    def line(name: str, condition: str, severity: str) -> str:
        holds = f"coalesce({condition}, false)" if strict else f"({condition})"
        failed = f"count(*) FILTER (WHERE NOT {holds})"
        return (
            f"SELECT '{name}' AS rule_name, '{severity}' AS severity, count(*) AS total_rows, "
            f"{failed} AS failed_rows, round({failed} * 100.0 / count(*), 2) AS failure_pct "
            f"FROM {source}"
        )

    return _with(source, "\nUNION ALL\n".join(line(*rule) for rule in rules))


_SILVER_CHECKS = [
    ("no_null_trans_date", "trans_date IS NOT NULL", "ERROR"),
    ("positive_amount", "amount > 0", "ERROR"),
    ("valid_stmt_month", "regexp_matches(statement_month, '^[0-9]{4}-[0-9]{2}$')", "ERROR"),
    ("no_null_description", "description IS NOT NULL", "ERROR"),
    ("known_category", f"category IN ({', '.join(map(_quoted, FEED_CATEGORIES))})", "WARN"),
    ("no_future_dates", f"trans_date <= DATE '{REPORT_DAY}'", "WARN"),
    ("reasonable_amount", "amount < 50000", "WARN"),
]
_LABEL_CHECKS = [(rule.name, rule.condition, rule.severity) for rule in LABEL_RULES]
# The default rules in normal form, for text that has no punctuation left.
_SEED_KEYWORDS = [(keyword.replace(".", " "), category) for keyword, category in SEED_RULES]
_DEFAULT_KEYWORDS = [(keyword.replace(".", " "), category) for keyword, category in KEYWORD_RULES]


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB per query that SQL can express."""
    more = _training_data()
    return _statement_sql() | (more.ORACLE_SQL if more else {})


def _statement_sql() -> dict[str, str]:
    silver_cols = ", ".join(SILVER_OUT)
    bronze_cols = f"{_RAW}, _batch_id, _row_hash"
    silver_rows = _with("silver", f"SELECT {silver_cols} FROM silver")
    merged = _with("merged", f"SELECT {bronze_cols} FROM merged")
    from_files = _with("merged", f"SELECT {_RAW}, _row_hash FROM merged")
    known = f"SELECT _row_hash FROM charges WHERE day < '{FIRST_DROP_UNTIL}'"
    new_rows = _with("silver", f", charges AS ({_CTES['charges']})") + f"""
        SELECT {silver_cols} FROM silver
        WHERE NOT EXISTS (SELECT 1 FROM ({known}) k WHERE k._row_hash = silver._row_hash)"""
    first_run = _quality_sql("labelled", _LABEL_CHECKS)
    second_run = _quality_sql("labelled", _LABEL_CHECKS, strict=True)
    built = _with(
        "merged",
        f"""
        , built AS ({_CTES["typed"].replace("FROM bronze", "FROM merged")})
        , labelled AS ({_CTES["silver"].replace("FROM typed", "FROM built")})
        SELECT {", ".join(name for name in SILVER_OUT if name != "_batch_id")} FROM labelled""",
    )
    return {
        "row_fingerprint": _with(
            "bronze", 'SELECT "Description", "Amount", _row_hash FROM bronze'
        ),
        "row_fingerprint_skip_nulls": _with(
            "feed", f'SELECT "Description", "Amount", {_HASH_SKIP} AS _row_hash FROM feed'
        ),
        "charges_only": _with("charges", f"SELECT {bronze_cols} FROM charges"),
        "statement_files": _with("feed", f"SELECT {_RAW} FROM feed"),
        "text_normalize": _with("typed", 'SELECT description AS "Description", description_norm FROM typed'),
        "text_normalize_documents": f"SELECT doc_id, {_norm('text')} AS text_norm FROM documents",
        "text_normalize_turns": (
            f"SELECT conv_id, turn, {_norm('text')} AS text_norm FROM conversations"
        ),
        "categorize_rules": _with(
            "silver", "SELECT description_norm, chase_category, category FROM silver"
        ),
        "categorize_documents": f"""
            SELECT doc_id, coalesce({_case("norm", _DEFAULT_KEYWORDS)}, 'Uncategorized') AS category
            FROM (SELECT doc_id, {_norm('text')} AS norm FROM documents)""",
        "keyword_hits": _with(
            "typed",
            f"""
            SELECT description AS "Description",
                   CASE WHEN contains(description_norm, 'GEAR') THEN 'Machines'
                        WHEN contains(description_norm, 'BOLT 1') THEN 'First bolts'
                        WHEN contains(description_norm, 'BOLT') THEN 'Hardware'
                   END AS keyword_category,
                   {_lookup("chase_category", FEED_MAP)} AS mapped_category
            FROM typed""",
        ),
        "categorize_rule_table": _with(
            "silver", "SELECT description_norm, chase_category, category FROM silver"
        ),
        "categorize_seed_rules": f"""
            SELECT doc_id, coalesce({_case("norm", _SEED_KEYWORDS)}, 'Uncategorized') AS category
            FROM (SELECT doc_id, {_norm('text')} AS norm FROM documents)""",
        "categorize_part_rules": _with(
            "typed",
            f"""
            , rules AS (SELECT p_partkey AS priority, {_norm("p_name || ' #' || p_partkey")}
                               AS keyword, p_brand AS category FROM part)
            , texts AS (SELECT DISTINCT description_norm FROM typed)
            , best AS (SELECT description_norm, arg_min(category, priority) AS hit
                       FROM texts JOIN rules ON contains(description_norm, keyword) GROUP BY ALL)
            SELECT description_norm, chase_category, amount,
                   coalesce(hit, {_lookup("chase_category", FEED_MAP)}, 'Uncategorized') AS category
            FROM typed LEFT JOIN best USING (description_norm)""",
        ),
        "statement_month": f"""
            SELECT o_orderkey, {_month("CAST(o_orderdate AS DATE)")} AS statement_month,
                   {_month("CAST(o_orderdate AS DATE)", 15)} AS mid_month
            FROM orders""",
        "silver_typed": silver_rows,
        "merge_insert_only": merged,
        "merge_idempotent": merged,
        "merge_key_history": merged,
        "merge_dedupe": _with("charges", f"SELECT DISTINCT {bronze_cols} FROM charges"),
        "merge_hot_keys": f"""
            SELECT o_orderkey, o_custkey, o_orderdate FROM orders
            WHERE o_orderdate < '{FIRST_ORDERS}' OR o_custkey NOT IN
                  (SELECT o_custkey FROM orders WHERE o_orderdate < '{FIRST_ORDERS}')""",
        "dedup_anti_join": new_rows,
        "month_counts": _with(
            "silver", "SELECT statement_month, count(*) AS count FROM silver GROUP BY ALL"
        ),
        "partitioned_append": silver_rows,
        "month_slice": f"""{silver_rows}
            WHERE statement_month = '1997-03' AND category = 'Hardware'""",
        "monthly_by_category": _monthly_sql("silver"),
        "fixed_vs_variable": _stability_sql("silver"),
        "recurring_charges": _recurring_sql("silver"),
        "recurring_thresholds": _recurring_sql("silver", 16, 0.6, 20),
        "recurring_top": _recurring_sql(
            "silver",
            tail="WHERE is_recurring ORDER BY median_amount DESC, description_norm, category LIMIT 25",
        ),
        "months_seen": _recurring_sql(
            "silver", select="description_norm, category, occurrence_months, months_seen"
        ),
        "recurring_customers": _recurring_sql("order_spend", 2, 0.5, 3),
        "recurring_defaults": _recurring_sql("steady_orders"),
        "default_rules": f"""
            WITH merchants AS (
                SELECT p_partkey, 'The ' || [{", ".join(_quoted(k) for k, _ in KEYWORD_RULES)}, 'NO RULE'][
                    p_partkey % {len(KEYWORD_RULES) + 1} + 1] || ' #' || p_partkey AS merchant,
                    [{", ".join(map(_quoted, SOURCE_CATEGORY_MAP))}, 'Other'][
                    (p_partkey // 7) % {len(SOURCE_CATEGORY_MAP) + 1} + 1] AS source
                FROM part
            ), normal AS (SELECT *, {_norm("merchant")} AS t FROM merchants)
            SELECT p_partkey, coalesce({_case("t", _DEFAULT_KEYWORDS)}, {_lookup("source", SOURCE_CATEGORY_MAP)},
                'Uncategorized') AS category FROM normal""",
        "source_files": " UNION ALL ".join(
            f"SELECT '{name}.parquet' AS file, count(*) AS row_count FROM {name}"
            for name in ("lineitem", "orders", "part")
        ),
        "monthly_orders": _monthly_sql("order_spend"),
        "events_daily": _monthly_sql("event_spend"),
        "events_daily_stability": _stability_sql("event_spend"),
        "quality_report": _quality_sql("silver", _SILVER_CHECKS),
        "quality_labels": first_run,
        "quality_labels_strict": second_run,
        "quality_log": f"SELECT * FROM ({first_run}) UNION ALL SELECT * FROM ({second_run})",
        "batch_ingest": from_files,
        "ingest_rejects": _with("charges", f"""
            , told AS (
                SELECT *, CAST(split_part("Description", '#', 2) AS INT) % 10 = 0 AS spoiled FROM feed
            )
            SELECT {_RAW_KEYS}, "Amount", false AS rejected FROM told WHERE NOT spoiled AND "Amount" < 0
            UNION ALL
            SELECT DISTINCT {_RAW_KEYS}, CAST(NULL AS DOUBLE), true FROM told WHERE spoiled"""),
        "silver_build": built,
        "silver_build_rule_table": built,
        "gold_refresh": _monthly_sql("silver"),
        "gold_stability": _stability_sql("silver"),
        "gold_recurring": _recurring_sql("silver"),
        "gold_refresh_by_month": _monthly_sql("silver"),
        "gold_stability_by_month": _stability_sql("silver"),
        "gold_recurring_by_month": _recurring_sql("silver"),
        "compact_preserves_rows": silver_rows,
        "compact_plain": "SELECT * FROM events",
        "compact_interleaved": "SELECT * FROM lineitem",
        "stream_ingest": _with("charges", f"SELECT DISTINCT {_RAW}, _row_hash FROM charges"),
        "stream_two_drops": _with("charges", f"SELECT DISTINCT {_RAW}, _row_hash FROM charges"),
        "stream_caps": _with("charges", f"""
            , drops AS (
                SELECT 1 AS which, * FROM charges WHERE day < '{FIRST_DROP_UNTIL}'
                UNION ALL SELECT 2, * FROM charges WHERE day >= '{SECOND_DROP_FROM}'
            ), counted AS (
                SELECT {_RAW}, which, count(*) AS n FROM drops GROUP BY ALL
            ), most AS (SELECT {_RAW}, max(n) AS n FROM counted GROUP BY ALL)
            SELECT cap, keep AS keep_copies, {_RAW}
            FROM most, unnest([1, 7, 1000]) AS c(cap), unnest([false, true]) AS k(keep),
                generate_series(1, CASE WHEN keep THEN n ELSE 1 END)"""),
        "compact_codes": """
            SELECT event_id, CASE event_id % 4 WHEN 0 THEN '01' WHEN 1 THEN '1' WHEN 2 THEN 'A7' END AS code
            FROM events""",
    }


def entry(spark: SparkSession) -> DataFrame:
    """Monthly spend per category of the statement feed."""
    return _monthly_by_category(spark, "/root/testdata/sf0.001")
