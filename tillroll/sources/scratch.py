"""Where jobs put tables that cut a plan in two."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_base: str | None = None


def _make_local_base() -> str:
    global _local_base
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="tillroll-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that the session names in ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder, which goes away with the
    process. On a cluster the setting is required, as executors cannot share a local folder.
    """
    base = spark.conf.get(_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CONF} to a folder that all executors can reach")
        base = _make_local_base()
    return f"{base.rstrip('/')}/tillroll/{label}-{uuid.uuid4().hex}"


def staged_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for what is read more than once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
