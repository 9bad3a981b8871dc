"""Makes this package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import millrace

_SHIPPED: set[str] = set()

# Rows of an Arrow batch where the session keeps Spark's own default, which is
# meant for short rows: whole texts of thousands of rows would sit in memory on
# both sides of every Python worker.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS, _ROWS = "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Send the package once per application; executors fetch it through Spark.

    Also makes Arrow batches small enough for long texts, unless the session
    has a size of its own.
    """
    if spark.conf.get(_BATCH, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_BATCH, _ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(millrace.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
