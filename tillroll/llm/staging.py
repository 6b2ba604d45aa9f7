"""Tables that cut a plan: written once to the folder all executors share, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.sources.scratch import scratch_path


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``.

    What reads it does not depend on the executors that made it, and Spark knows its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
