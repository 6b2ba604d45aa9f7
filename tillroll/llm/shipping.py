"""Makes this package importable in Python workers that were not started with it on their path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from tillroll.llm.memory import bound_batches

_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers through Spark, once per application, and bound their batches.

    Nothing is sent where it lies in ``PYTHONPATH`` or in the working folder, which workers inherit.
    """
    bound_batches(spark)
    context = spark.sparkContext
    known = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if context.applicationId in _shipped or _ROOT in [path.resolve() for path in known]:
        return
    folder = tempfile.mkdtemp(prefix="tillroll-")  # Spark serves the file while the application runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "tillroll.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted((_ROOT / "tillroll").rglob("*.py")):
            file.write(path, path.relative_to(_ROOT))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
