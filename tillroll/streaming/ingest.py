"""Ingesting statement files as they are dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.hashing import row_fingerprint
from tillroll.operators.charges import only_charges
from tillroll.plans.rejects import Rejects
from tillroll.plans.statements import merge_accepted, merge_bronze, with_metadata, with_source_file
from tillroll.sources.statements import stream_statements
from tillroll.sources.tables import has_marker, put_marker

# Each micro-batch searches the table once, so files are taken many at a time.
FILES_PER_TRIGGER = 1000
# Fixed value: Spark's setting by which a statement's shuffle files are removed when it ends, and not when the
# driver happens to collect garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ingest_statements_stream(
    spark: SparkSession,
    source: str,
    bronze: str,
    checkpoint: str,
    *,
    glob: str = "*.csv",
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
    processing_time: str | None = None,
    keep_copies: bool = False,
    by_month: bool = True,
    skip_nulls: bool = False,
    rejects: Rejects | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that merges each statement file dropped into ``source`` into the bronze table.

    By default it takes what is there and ends; await it. With ``processing_time``, such as
    ``"1 minute"``, it goes on until it is stopped. ``checkpoint`` remembers the files taken and
    must lie outside the table.

    Every micro-batch goes through the same merge as a batch ingest and reads the table anew, so
    one that is delivered again after a failure, or a file dropped under a second name, adds
    nothing. A fingerprint is kept once. With ``keep_copies`` a row stays as often as the file that
    has it most often has it, as equal purchases in one file may all be real. Either way the result
    depends on the files alone, not on how they fall into micro-batches. The table is searched in
    the months of the micro-batch (see :func:`~tillroll.plans.ingest_statements`).

    When a micro-batch is merged, a marker with its number is put into the folder ``merged`` of the
    checkpoint. One that is delivered again although it was merged, as Spark had not noted that yet, is
    passed over without reading files or table. A checkpoint that is begun anew has no markers.

    ``rejects`` keeps lines that do not parse apart, as in a batch ingest; without it they end the query.
    """
    if checkpoint.rstrip("/").startswith(bronze.rstrip("/") + "/") or checkpoint == bronze:
        raise ValueError("the checkpoint must lie outside the table")
    raw = stream_statements(
        spark,
        source,
        glob=glob,
        options=options,
        max_files_per_trigger=max_files_per_trigger,
        keep_rejected=rejects is not None,
    )
    merged = f"{checkpoint.rstrip('/')}/merged"
    merging = {"dedupe": True, "keep_copies": keep_copies, "by_month": by_month}

    def named(rows: DataFrame) -> DataFrame:
        return with_metadata(rows, source, skip_nulls)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if has_marker(spark, merged, batch_id):
            return
        # the stream has a session of its own
        batch.sparkSession.conf.set(CLEAN_SHUFFLES, "true")
        if rejects is None:
            fingerprint = row_fingerprint(skip_nulls=skip_nulls)
            merge_bronze(only_charges(batch), bronze, derive=named, key=fingerprint, **merging)
        else:
            merge_accepted(batch, source, bronze, rejects, skip_nulls=skip_nulls, **merging)
        put_marker(spark, merged, batch_id)

    writer = (
        with_source_file(raw).writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
    )
    if name is not None:
        writer = writer.queryName(name)
    if processing_time is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
