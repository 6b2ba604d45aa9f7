"""Shards of near equal size in bytes, by sampled splitters, with Spark expressions only.

Documents are ordered by a hash of their text, then id, so that equal texts are neighbours. A sample
in which a document is drawn in proportion to its size gives quantile boundaries, which cut the
order into ranges; a range that holds too many rows is cut again by a sample of its own. Ranges are
numbered and summed exactly, and a document's shard follows from the exact number of bytes before
it, so the sample decides how the work is spread and never the result for a key.

Groups of equal texts stay in one shard if they are at most ``whole_group`` of a shard's size;
larger ones may be cut where a shard ends. Splitters fall between groups, except in a group so large
that it holds several of them: it is cut by id and never sorted in one task.

Defined cases: a NULL text has no bytes and size 1; repeated rows and ties take slots next to each
other; NULL ids come first within their group; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.staging import staged

FAN_OUT = 32
DRAWS_PER_RANGE = 64
MAX_RANGE_ROWS = 1_000_000
_MAX_LEVELS = 12
_PLACE = ("key", "doc_id", "salt")


def _place() -> Column:
    return F.struct(*_PLACE)


def _splitters(rows: DataFrame, totals: DataFrame, fan_out: int, draws: int) -> DataFrame:
    """Per range, boundaries at the quantiles of a sample weighted by size."""
    wanted = fan_out * draws
    chance = F.col("size") * wanted / F.col("range_bytes")
    uniform = F.shiftrightunsigned(F.xxhash64(*_PLACE, "range"), 11) / F.lit(float(1 << 53))
    sample = (
        rows.join(totals, "range")
        .withColumn("times", F.floor(chance + uniform).cast("int"))
        .where("times > 0")
        .groupBy("range")
        .agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat(_place(), F.col("times"))))).alias("drawn"))
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.lit(fan_out - 1)),
        lambda i: F.get(F.col("drawn"), F.floor(i * F.size("drawn") / fan_out).cast("int")),
    )
    # A key that is drawn for several boundaries is hot and cut by id; others are kept whole.
    whole = F.transform(
        F.col("cuts"),
        lambda c: F.when(
            F.size(F.filter(F.col("cuts"), lambda o: o["key"] == c["key"])) > 1, c
        ).otherwise(
            F.struct(
                c["key"].alias("key"),
                F.lit(None).cast("long").alias("doc_id"),
                F.lit(None).cast("long").alias("salt"),
            )
        ),
    )
    return sample.select("range", cuts.alias("cuts")).select("range", whole.alias("cuts"))


def _ranges(rows: DataFrame, fan_out: int, draws: int, max_rows: int) -> DataFrame:
    """``rows`` with a ``range`` number that follows the order; no range has too many rows."""
    ranged = rows.withColumn("range", F.lit(0).cast("long"))
    for level in range(_MAX_LEVELS):
        sums = ranged.groupBy("range").agg(F.sum("size").alias("range_bytes"), F.count("*").alias("n"))
        overfull = sums.where(F.col("n") > max_rows) if level else sums
        overfull = staged(overfull.drop("n"), "shard-ranges")
        if overfull.isEmpty():
            break
        splitters = staged(_splitters(ranged, overfull, fan_out, draws), "shard-splitters")
        part = F.size(F.filter(F.col("cuts"), lambda c: c <= _place()))
        ranged = staged(
            ranged.join(splitters, "range", "left").select(
                *rows.columns,
                (F.col("range") * fan_out + F.when(F.col("cuts").isNull(), 0).otherwise(part)).alias("range"),
            ),
            "shard-rows",
        )
    return ranged


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    whole_group: float = 0.02,
    fan_out: int = FAN_OUT,
    draws_per_range: int = DRAWS_PER_RANGE,
    max_range_rows: int = MAX_RANGE_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text plus one. ``slot`` numbers a shard's documents from 0
    without gaps.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw")).select(
            "doc_id",
            (F.octet_length("raw") + F.lit(1)).cast("long").alias("size"),
            F.crc32("raw").alias("text_crc32"),
            F.xxhash64("raw").alias("key"),
            # Tells repeated rows apart when a very large group of them has to be cut.
            F.monotonically_increasing_id().alias("salt"),
        ),
        "shard-sizes",
    )
    ranged = _ranges(rows, fan_out, draws_per_range, max_range_rows)
    sums = ranged.groupBy("range").agg(F.sum("size").alias("range_bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so a row per million documents at most: small enough for one task.
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("range_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("range_bytes").over(Window.partitionBy()).alias("total"),
    )
    in_order = Window.partitionBy("range").orderBy(*_PLACE)
    running = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    group = Window.partitionBy("range", "key")
    numbered = (
        ranged.withColumn("ahead", F.coalesce(running, F.lit(0)))
        .withColumn("rank", F.row_number().over(in_order))
        .withColumn("group_bytes", F.sum("size").over(group))
        .withColumn("group_ahead", F.min("ahead").over(group))
        .join(offsets, "range")
    )
    share = F.col("total") / shards
    middle = F.col("bytes_before") + F.when(
        F.col("group_bytes") <= share * whole_group, F.col("group_ahead") + F.col("group_bytes") / 2
    ).otherwise(F.col("ahead") + F.col("size") / 2)
    placed = staged(
        numbered.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle / share), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rank") - 1).alias("row"),
        ),
        "shard-places",
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )
