"""Column layouts of the statement feed and of the tables built from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of a card statement export, in file order.
RAW_SCHEMA = T.StructType([
    T.StructField("Transaction Date", T.StringType()),
    T.StructField("Post Date", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Amount", T.DoubleType()),
    T.StructField("Memo", T.StringType()),
])

RAW_COLUMNS = RAW_SCHEMA.fieldNames()

BRONZE_SCHEMA = T.StructType(RAW_SCHEMA.fields + [
    T.StructField("_ingest_ts", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_row_hash", T.StringType()),
])

SILVER_SCHEMA = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("chase_category", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("memo", T.StringType()),
    T.StructField("_ingest_ts", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_row_hash", T.StringType()),
    T.StructField("trans_date", T.DateType()),
    T.StructField("post_date", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("description_norm", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("statement_month", T.StringType()),
    T.StructField("is_credit", T.BooleanType()),
    T.StructField("_silver_ts", T.TimestampType()),
])

QUALITY_REPORT_SCHEMA = T.StructType([
    T.StructField("rule_name", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("failed_rows", T.LongType()),
    T.StructField("failure_pct", T.DoubleType()),
])

QUALITY_LOG_SCHEMA = T.StructType(
    QUALITY_REPORT_SCHEMA.fields + [T.StructField("checked_at", T.TimestampType())]
)

RULE_TABLE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("category", T.StringType()),
])
