"""Rewriting a table of many small files into fewer, ordered ones."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.sources.tables import TABLE_CODEC, read_table

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Rows that one task sorts take about so much memory; files are smaller where they would need more.
SORT_BYTES = 768 * 1024 * 1024
# Ranks that interleaved clustering gives the values of a column, as bits, and the rows it draws for them.
RANK_BITS = 8
SAMPLED_ROWS = 20_000
# Texts are ranked by as many characters.
_RANKED_CHARS = 64


@dataclass(frozen=True)
class Compaction:
    """Data files and their bytes before and after."""

    files_before: int
    files_after: int
    bytes_before: int
    bytes_after: int


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, file_size)`` of the data files of a table, from a listing; no row is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def _measure(spark: SparkSession, path: str) -> tuple[int, int]:
    row = file_sizes(spark, path).agg(F.count(F.lit(1)), F.coalesce(F.sum("file_size"), F.lit(0))).first()
    return row[0], row[1]


def _stored_schema(spark: SparkSession, path: str) -> StructType:
    """The types in the data files; columns that only directories hold are strings, as named there."""
    found = read_table(spark, path).schema
    one_file = file_sizes(spark, path).first()
    in_files = {} if one_file is None else {f.name: f for f in read_table(spark, one_file["file_path"]).schema}
    return StructType([in_files.get(f.name, StructField(f.name, StringType())) for f in found])


def _sorted_bytes(table: DataFrame, stored_bytes: int) -> int:
    """About the memory that all rows take while they are sorted.

    A row has 8 bytes for each column and as many for its keys and its place in the order; texts, of which
    a file has each once in a block of rows, are taken as three times what is stored.
    """
    return table.count() * 16 * len(table.columns) + 3 * stored_bytes  # counted from the footers of the files


def _rankable(column: str, schema: StructType) -> Column:
    value = F.col(f"`{column}`")
    return F.substring(value, 1, _RANKED_CHARS) if isinstance(schema[column].dataType, StringType) else value


def rank_boundaries(table: DataFrame, columns: Sequence[str], seed: int = 0) -> dict[str, list]:
    """For each column ``2 ** RANK_BITS - 1`` values that cut a sample of its rows into equal parts.

    The sample has about ``SAMPLED_ROWS`` rows whatever the table has. It decides where rows lie, not
    which rows there are. A column without values has no boundaries.
    """
    rows = table.count()  # from the footers of the files
    drawn = table.sample(min(1.0, SAMPLED_ROWS / max(rows, 1)), seed)
    sample = drawn.select(*[_rankable(c, table.schema).alias(f"_{i}") for i, c in enumerate(columns)]).collect()
    parts, boundaries = 1 << RANK_BITS, {}
    for i, column in enumerate(columns):
        values = sorted(row[i] for row in sample if row[i] is not None and row[i] == row[i])
        boundaries[column] = [values[len(values) * k // parts] for k in range(1, parts)] if values else []
    return boundaries


def interleaved_key(columns: Sequence[str], boundaries: dict[str, list], schema: StructType) -> Column:
    """A number whose order keeps rows together that are near each other in all ``columns``.

    A value's rank is the number of boundaries up to it, found by halving; NULL has rank 0. The bits of
    the ranks are interleaved, the highest bits of all columns first.
    """
    if len(columns) * RANK_BITS > 62:
        raise ValueError(f"at most {62 // RANK_BITS} columns can be interleaved")

    def rank(column: str) -> Column:
        if not boundaries[column]:
            return F.lit(0)
        value, kind = _rankable(column, schema), schema[column].dataType
        known = F.array(*[F.lit(v).cast(kind) for v in boundaries[column]])
        steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(RANK_BITS))])
        return F.aggregate(
            steps,
            F.lit(0),
            lambda found, step: F.when(value >= F.element_at(known, found + step), found + step).otherwise(found),
        )

    def spread(ranked: Column, offset: int) -> Column:
        def place(bit: int) -> Column:
            one = F.shiftright(ranked, bit).bitwiseAND(F.lit(1)).cast("long")
            return F.shiftleft(one, bit * len(columns) + offset)

        return functools.reduce(Column.bitwiseOR, map(place, range(RANK_BITS)))

    ranks = F.array(*map(rank, columns))
    # a single-element array binds the ranks, so that they are found once and not once per bit
    bound = F.transform(
        F.array(ranks),
        lambda found: functools.reduce(
            Column.bitwiseOR, [spread(F.get(found, F.lit(i)), len(columns) - 1 - i) for i in range(len(columns))]
        ),
    )
    return F.get(bound, F.lit(0))


def compact_table(
    spark: SparkSession,
    path: str,
    out_path: str,
    *,
    cluster_by: Sequence[str] = (),
    interleave: bool = False,
    partition_by: str | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    sort_bytes: int = SORT_BYTES,
    schema: StructType | None = None,
) -> Compaction:
    """Write the rows of ``path`` to the new table ``out_path`` in files of about the target size.

    With ``partition_by`` or ``cluster_by`` the rows are range-partitioned and sorted on those
    columns, so that the statistics of each file and row group span few values and readers can skip
    most of them. Ranges end in the position of a row in its file: it tells equal rows apart, so
    that a value which fills a large part of the table is spread over several files, and it is the
    same when a lost task runs again. Without columns to order by, nothing is shuffled. A task sorts
    about ``sort_bytes`` of rows at most, which can make files smaller than the target.

    By default rows are ordered by the first column of ``cluster_by``, then the second, so that only
    filters on the first skip much. With ``interleave`` they are ordered by an interleaved key of the
    ranks of all these columns (see :func:`interleaved_key`), so that a filter on any of them does.

    Values are kept as they are. A column that is stored as directories is text unless ``schema``
    says otherwise; read the new table with the same schema. A directory cannot tell an empty text
    from NULL, so a table that holds one cannot become partitioned by it.
    """
    schema = schema or _stored_schema(spark, path)
    table = read_table(spark, path, schema)
    files_before, bytes_before = _measure(spark, path)
    if partition_by is not None and isinstance(schema[partition_by].dataType, StringType):
        if not table.where(F.col(partition_by) == "").isEmpty():
            raise ValueError(f"{partition_by} holds an empty text, which a directory would turn into NULL")
    n = max(1, math.ceil(bytes_before / target_file_bytes))
    clustered = [F.col(f"`{c}`") for c in cluster_by]
    if interleave and cluster_by:
        clustered = [interleaved_key(cluster_by, rank_boundaries(table, cluster_by), schema)]
    order = [*([] if partition_by is None else [F.col(f"`{partition_by}`")]), *clustered]
    if order:
        n = max(n, math.ceil(_sorted_bytes(table, bytes_before) / sort_bytes))
        position = ["_position_file", "_position_row"]
        # an interleaved key is made once; stored columns are not shuffled a second time as keys
        made = {"_order": clustered[0]} if interleave and cluster_by else {}
        keys = [F.col(name) for name in made] or clustered
        keys = [*order[: len(order) - len(keys)], *keys]
        laid_out = (
            table.select(
                "*",
                F.xxhash64("_metadata.file_path").alias(position[0]),
                F.col("_metadata.row_index").alias(position[1]),
                *[column.alias(name) for name, column in made.items()],
            )
            .repartitionByRange(n, *keys, *position)
            .sortWithinPartitions(*keys)
            .drop(*made, *position)
        )
    else:
        laid_out = table.coalesce(n)
    writer = laid_out.write.mode("errorifexists")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(out_path, compression=TABLE_CODEC)
    files_after, bytes_after = _measure(spark, out_path)
    return Compaction(files_before, files_after, bytes_before, bytes_after)
