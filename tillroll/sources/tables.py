"""Parquet tables by path.

The tables have no transaction log: each has one writer at a time, and a path is never overwritten
by a job that reads it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What Spark reports for a missing directory, and for one without data files.
_NO_TABLE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}

# Fixed value: what Spark calls the directory of NULL.
_NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Hash buckets of a partitioned write; Spark joins the small ones again.
REBALANCE_BUCKETS = 1024

# Fixed value: the codec of stored tables. Fingerprints are hexadecimal text, of which Spark's default
# codec saves nothing and this one half.
TABLE_CODEC = "zstd"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The whole table at ``path``; pass the schema to fix types instead of taking the files'."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def find_table(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in _NO_TABLE:
            return None
        raise


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to the table at ``path``; the first write creates it."""
    df.write.mode("append").parquet(path, compression=TABLE_CODEC)


def append_partitioned(
    df: DataFrame,
    path: str,
    partition_by: str,
    *,
    deal_by: Column | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Add rows to a table that keeps one directory per value of ``partition_by``.

    The rows are rebalanced on that column first: small values share a task and give one file
    each, while a value that holds a large part of all rows is split over as many tasks as its
    size asks for (``spark.sql.adaptive.advisoryPartitionSizeInBytes``). Small values that share a
    hash bucket with a large one would be cut up along with it, so there are many buckets.

    ``derive`` makes the stored rows from those of ``df``, row by row, once these are rebalanced: what it
    adds to a row, such as a fingerprint, is not shuffled. ``deal_by`` then says which value of
    ``partition_by`` a row of ``df`` will have; it decides which task writes a row, not where to.
    """
    _by_partition(df, partition_by, deal_by, derive).mode("append").parquet(path, compression=TABLE_CODEC)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Like :func:`append_partitioned`, but each directory that gets rows loses those it had.

    Other directories stay. Spark writes all rows aside before it replaces the first directory; a job
    that dies while it does is completed by running it again.
    """
    writer = _by_partition(df, partition_by).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path, compression=TABLE_CODEC)


def _by_partition(
    df: DataFrame,
    partition_by: str,
    deal_by: Column | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrameWriter:
    buckets = max(REBALANCE_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if deal_by is None:
        dealt = df.hint("rebalance", buckets, partition_by)
    else:
        dealt = df.withColumn("_deal_by", deal_by).hint("rebalance", buckets, "_deal_by").drop("_deal_by")
    return (dealt if derive is None else derive(dealt)).write.partitionBy(partition_by)


def replace_table(df: DataFrame, path: str) -> None:
    """Write a derived table anew. A small result gives one file, a large one as many as it needs.

    The new table is written beside the old one, in a folder whose name readers ignore, and takes its
    place by renaming when it is complete. A job that fails or dies before leaves the old table as it is.
    The old one is deleted last; between the two renamings it lies in a folder ``_old-...`` beside.
    """
    spark = df.sparkSession
    place = _hadoop_path(spark, path.rstrip("/"))
    files, tag = place.getFileSystem(spark._jsc.hadoopConfiguration()), uuid.uuid4().hex
    new, old = (_hadoop_path(spark, f"{place.getParent().toString()}/_{kind}-{place.getName()}-{tag}") for kind in ("new", "old"))
    try:
        df.hint("rebalance").write.parquet(new.toString(), compression=TABLE_CODEC)
        had_one = files.exists(place)
        if had_one:
            _rename(files, place, old)
        try:
            _rename(files, new, place)
        except OSError:
            if had_one:
                _rename(files, old, place)
            raise
        files.delete(old, True)
    finally:
        files.delete(new, True)
    # Readers of this session that know the old files forget them.
    spark.catalog.refreshByPath(path)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not rename {source.toString()} to {target.toString()}")


def files_by_directory(table: DataFrame, column: str) -> dict[str, str]:
    """A digest of the data file names per directory of ``column``, from the listing that Spark has made.

    Spark gives each file it writes a new name, so that an append, a compaction or a replacement
    changes the digest. Directories are named as in ``month=2024-01``.
    """
    found = defaultdict(list)
    for uri in table.inputFiles():
        *folders, name = uri.split("/")
        here = next((folder for folder in map(unquote, reversed(folders)) if folder.startswith(f"{column}=")), None)
        if here is None:
            raise ValueError(f"the table must have a directory per {column}: {uri}")
        found[here].append(name)
    return {here: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for here, names in found.items()}


def directory_values(column: str, directories: Iterable[str]) -> list[str | None]:
    """The texts that name directories of ``column``, as :func:`files_by_directory` has them."""
    texts = [unquote(name.removeprefix(f"{column}=")) for name in directories]
    return [None if text == _NULL_VALUE else text for text in texts]


def in_directories(column: str, directories: Iterable[str]) -> Column:
    """Rows of these directories; Spark reads no other. Never NULL."""
    values = directory_values(column, directories)
    inside = F.coalesce(F.col(column).isin([value for value in values if value is not None]), F.lit(False))
    return inside | F.col(column).isNull() if None in values else inside


def count_per_value(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, in the order of the values."""
    return df.groupBy(column).count().orderBy(column)


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove the table at ``path``, in whatever store it lies."""
    place = _hadoop_path(spark, path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def has_marker(spark: SparkSession, folder: str, number: int) -> bool:
    """Whether :func:`put_marker` was called with this number."""
    place = _hadoop_path(spark, f"{folder}/{number}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def put_marker(spark: SparkSession, folder: str, number: int) -> None:
    """Remember a number by an empty file that is named after it, and forget the one before the last."""
    place = _hadoop_path(spark, f"{folder}/{number}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.create(place, True).close()
    files.delete(_hadoop_path(spark, f"{folder}/{number - 2}"), False)
