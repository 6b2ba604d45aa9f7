"""Text columns: normalising descriptions and trimming labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks deleted (not replaced by a space) when text is normalised.
APOSTROPHES = "'‘’`"

# Unicode white space, and the four separator controls that count as white space in text files.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def normalize_text(text: Column) -> Column:
    """Upper-case words of ``A-Z0-9`` with one space between; apostrophes vanish, NULL is ``""``.

    A chain of built-in expressions, so it stays inside the generated code of its stage.
    """
    upper = F.upper(F.coalesce(text, F.lit("")))
    for mark in APOSTROPHES:  # plain replacement takes half the time of a pattern here
        upper = F.replace(upper, F.lit(mark), F.lit(""))
    return F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", " "))


def strip_text(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def normalize_keyword(keyword: str) -> str:
    """:func:`normalize_text` for one driver-side keyword, so that rules and text agree."""
    kept = "".join(ch for ch in keyword.upper() if ch not in APOSTROPHES)
    return " ".join(re.findall("[A-Z0-9]+", kept))
