"""Rows and files that the tests share."""

from __future__ import annotations

import csv
import os

from tillroll.schemas import RAW_COLUMNS, RAW_SCHEMA

SPEND_SCHEMA = (
    "description_norm string, category string, amount double, statement_month string, "
    "is_credit boolean"
)
TESTDATA = "/root/testdata/sf0.001"


def raw_row(day="01/15/2024", text="CORNER CAFE", category="Food & Drink", amount=-5.75, **other):
    row = {
        "Transaction Date": day,
        "Post Date": day,
        "Description": text,
        "Category": category,
        "Type": "Sale",
        "Amount": amount,
        "Memo": None,
    }
    row.update(other)
    return tuple(row[name] for name in RAW_COLUMNS)


def raw_df(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def spend_df(spark, *rows):
    """Rows of (merchant, category, amount, month) and, optionally, a credit flag."""
    full = [row if len(row) == 5 else (*row, False) for row in rows]
    return spark.createDataFrame(full, SPEND_SCHEMA)


def write_csv(path, rows, header=RAW_COLUMNS):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\r\n")
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in row] for row in rows])


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def final_plan(df):
    """The physical plan after adaptive re-planning, as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
