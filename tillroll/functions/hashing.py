"""Content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import RAW_COLUMNS

# Fixed value: the separator between the fields of a fingerprint.
FIELD_SEPARATOR = "|"


def row_fingerprint(columns: Sequence[str] = RAW_COLUMNS, *, skip_nulls: bool = False) -> Column:
    """SHA-256 over the text of the columns; depends on content only, not on file or time.

    A NULL field counts as an empty one, so the position of a NULL matters. With ``skip_nulls``
    NULL fields are left out altogether: ``(a, NULL, b)`` and ``(a, b, NULL)`` then collide, but
    the values equal those of tables that were fingerprinted that way.
    """
    fields = [F.col(f"`{name}`").cast("string") for name in columns]
    if not skip_nulls:
        fields = [F.coalesce(field, F.lit("")) for field in fields]
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *fields), 256)


def batch_fingerprint(source: str) -> Column:
    """SHA-1 of the name a batch was loaded from."""
    return F.sha1(F.lit(source))
