"""Column expressions. All are built from Spark's own functions; none is a Python UDF."""

from tillroll.functions.category import categorize, keyword_category, mapped_category
from tillroll.functions.dates import parse_statement_date, statement_month
from tillroll.functions.hashing import batch_fingerprint, row_fingerprint
from tillroll.functions.numeric import label_below, percent_of, ratio_if_positive
from tillroll.functions.text import normalize_keyword, normalize_text, strip_text

__all__ = [
    "batch_fingerprint",
    "categorize",
    "keyword_category",
    "label_below",
    "mapped_category",
    "normalize_keyword",
    "normalize_text",
    "parse_statement_date",
    "percent_of",
    "ratio_if_positive",
    "row_fingerprint",
    "statement_month",
    "strip_text",
]
