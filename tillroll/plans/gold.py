"""Gold tables kept up to date from counts per month, of which only changed months are counted again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tillroll.operators.recurring import counted_amounts
from tillroll.plans.statements import MONTH, publish_gold
from tillroll.schemas import SILVER_SCHEMA
from tillroll.sources.tables import (
    delete_table,
    files_by_directory,
    find_table,
    in_directories,
    read_table,
    replace_partitions,
    replace_table,
)

COUNTS_SCHEMA = T.StructType([
    *(SILVER_SCHEMA[name] for name in ("description_norm", "category", "amount")),
    T.StructField("n", T.LongType()),
    SILVER_SCHEMA[MONTH],
])
STATE_SCHEMA = "directory string, files string"


def refresh_counts(spark: SparkSession, silver: str, counts: str, state: str) -> set[str]:
    """Bring the counted amounts of each month up to date; the directories of the months that changed.

    ``counts`` has how often each merchant charged each amount (:func:`counted_amounts`), in a directory
    per month. ``state`` has, for each month, a digest of the names of the silver files it was counted
    from. A month whose files are no longer those, be it by an append, a compaction or a deletion, is
    counted again from all its rows and its directory replaced. No other month of silver is read. The
    state is written last: a refresh that dies is completed by the next one.

    File names must be new where content is, as those that Spark writes are. One refresh at a time.
    """
    rows = find_table(spark, silver, SILVER_SCHEMA)
    present = {} if rows is None else files_by_directory(rows, MONTH)
    last = find_table(spark, state)
    known = {} if last is None else {row["directory"]: row["files"] for row in last.collect()}  # one per month
    changed = {month for month in present if known.get(month) != present[month]}
    gone = set(known) - set(present)
    if changed:
        before = _counted_files(spark, counts)
        replace_partitions(counted_amounts(rows.where(in_directories(MONTH, changed))), counts, MONTH)
        after = _counted_files(spark, counts)
        # Months that have no charge any more gave no directory that would replace the old one.
        gone |= {month for month in changed & set(before) if after.get(month) == before[month]}
    for month in gone:
        delete_table(spark, f"{counts}/{month}")
    if changed or gone or last is None:
        replace_table(spark.createDataFrame(sorted(present.items()), STATE_SCHEMA), state)
    spark.catalog.refreshByPath(counts)
    return changed | (set(known) - set(present))


def _counted_files(spark: SparkSession, counts: str) -> dict[str, str]:
    table = find_table(spark, counts, COUNTS_SCHEMA)
    return {} if table is None else files_by_directory(table, MONTH)


def refresh_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    *,
    stability: Mapping[str, float] | None = None,
    recurring: Mapping[str, object] | None = None,
) -> set[str]:
    """The tables of :func:`~tillroll.plans.build_gold`, from counts that are kept beside them.

    The first refresh counts all months of ``silver``, later ones those whose files changed. The counts
    are in ``counted_amounts`` below ``gold`` and what they were counted from in ``counted_months``. Returns
    the directories of the months that were counted again or dropped. A ``median_accuracy`` in
    ``recurring`` asks for a sketch of all charges, which reads all months.
    """
    counts, state = f"{gold}/counted_amounts", f"{gold}/counted_months"
    changed = refresh_counts(spark, silver, counts, state)
    amounts = find_table(spark, counts, COUNTS_SCHEMA)
    if amounts is None:
        amounts = spark.createDataFrame([], COUNTS_SCHEMA)
    publish_gold(amounts, gold, lambda: read_table(spark, silver, SILVER_SCHEMA), stability, recurring)
    return changed
