"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, as a machine-local folder would be
    lost together with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    configured = named or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc.getCheckpointDir().rstrip("/")


# Paths made since the innermost open scope began; None outside of any.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder where Spark's file system finds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Intermediates written inside are removed at the end, also after an error.

    A query's result is lazy and reads what its builder wrote, so the result is
    to be written (or collected) inside too::

        with scope(spark):
            query(spark, folder).write.parquet(target)

    Until the end the files lie in the shared folder, where every executor finds
    them again when another one is lost.  Scopes nest: a path belongs to the
    innermost one, and taking it out of the list that the scope gives keeps it.
    Nothing is cached in memory, so nothing has to be unpersisted.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        for path in paths:
            remove(spark, path)


def fresh_path(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder; it belongs to the open scope, if any."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    paths = _SCOPE.get()
    if paths is not None:
        paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    Used where two later steps must see exactly the same rows, or where a
    reused intermediate has to survive the loss of an executor.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
