"""Statement feeds made from business tables, so that the operators can run on them.

Each adapter is a plain projection: charges are negative and dates are text, as in a card export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import STATEMENT_DATE_FORMAT


def lineitem_feed(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One card transaction per line item, bought at the part as its merchant.

    Returned items are payments. Every fourth part is billed at its list price, so that it charges
    the same amount each time; the rest are billed at the price of the line.
    """
    paid = F.when(F.col("p_partkey") % 4 == 0, F.col("p_retailprice")).otherwise(
        F.col("l_extendedprice")
    )
    is_return = F.col("l_returnflag") == "R"
    shipped = F.col("l_shipdate").cast("date")
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.date_format(shipped, STATEMENT_DATE_FORMAT).alias("Transaction Date"),
        F.date_format(F.date_add(shipped, F.col("l_linenumber")), STATEMENT_DATE_FORMAT).alias(
            "Post Date"
        ),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias(
            "Description"
        ),
        F.col("p_type").alias("Category"),
        F.when(is_return, "Payment").otherwise("Sale").alias("Type"),
        F.when(is_return, paid).otherwise(-paid).alias("Amount"),
        F.lit(None).cast("string").alias("Memo"),
    )


def order_spend(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as typed spend: the customer is the merchant, the priority the category.

    Orders with status ``F`` count as credits.
    """
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.upper("c_name").alias("description_norm"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amount"),
        F.substring(F.col("o_orderdate").cast("date").cast("string"), 1, 7).alias(
            "statement_month"
        ),
        (F.col("o_orderstatus") == "F").alias("is_credit"),
    )


def event_spend(events: DataFrame) -> DataFrame:
    """Events as typed spend, with the day as the period; errors count as credits."""
    return events.select(
        F.concat(F.lit("USER "), F.col("user_id").cast("string")).alias("description_norm"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amount"),
        F.col("ts").cast("date").cast("string").alias("statement_month"),
        (F.col("event_type") == "error").alias("is_credit"),
    )
