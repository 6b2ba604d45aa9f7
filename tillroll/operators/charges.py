"""Raw statement rows: ingest metadata and the charge filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.hashing import batch_fingerprint, row_fingerprint


def add_ingest_metadata(
    raw: DataFrame, source: str, *, source_file: Column | None = None, skip_nulls: bool = False
) -> DataFrame:
    """Add when and from where a row came, and the fingerprint of its content.

    ``source_file`` is the file column of a scan, ``col("_metadata.file_path")``; rows that come
    from no file get an empty name. Unlike ``input_file_name()`` that column is deterministic, so
    filters still move below this step and into the reader.
    """
    return raw.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        (F.lit("") if source_file is None else source_file).alias("_source_file"),
        batch_fingerprint(source).alias("_batch_id"),
        row_fingerprint(skip_nulls=skip_nulls).alias("_row_hash"),
    )


def only_charges(raw: DataFrame, amount: str = "Amount") -> DataFrame:
    """Rows with a negative amount. Payments, credits, zeros and rows without an amount go."""
    return raw.where(F.col(amount) < 0)
