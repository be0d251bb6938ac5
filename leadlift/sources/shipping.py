"""Makes this package importable in Python workers, wherever the job was started from."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application, as ``--py-files`` would.

    Spark's driver serves the archive to the executors; nothing else reads the driver's folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="leadlift-"), "leadlift_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
