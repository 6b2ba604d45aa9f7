"""Date columns: strict parsing and the statement-month bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date format of a statement file, and the first day of a month that is
# billed on the next month's statement.
STATEMENT_DATE_FORMAT = "MM/dd/yyyy"
STATEMENT_CUT_DAY = 29


def parse_statement_date(text: Column, fmt: str = STATEMENT_DATE_FORMAT) -> Column:
    """Parse a date; text that does not fit the format gives NULL, also in ANSI mode."""
    return F.try_to_date(text, fmt)


def statement_month(day: Column, cut_day: int = STATEMENT_CUT_DAY) -> Column:
    """The ``yyyy-MM`` statement a date is billed on; from ``cut_day`` on it is the next month's.

    Works on the text of the date, with no time zone and no pattern formatter involved.
    """
    billed = F.when(F.dayofmonth(day) >= cut_day, F.add_months(F.trunc(day, "month"), 1))
    return F.substring(billed.otherwise(day).cast("date").cast("string"), 1, 7)
