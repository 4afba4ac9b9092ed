"""Makes this package importable in the Python workers of every executor."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import ledgerlens

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors the package's source (once for an application), as
    ``--py-files`` would; harmless where they have it already."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(ledgerlens.__file__))
    # Only the driver reads this file; Spark hands it to the executors.
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("ledgerlens", os.path.relpath(full, root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
