"""Intermediate tables written to shared storage.

Operators that read an input several times, or number rows by file position, need
one fixed copy of it. The copy is a parquet table below ``spark.checkpoint.dir``,
the shared folder the cluster names (else below the warehouse), so it outlives lost executors, later passes
read only the columns they use, and the lineage behind it is cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_staged: dict[str, list[str]] = {}


def _root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder below the warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in shared storage, deleted by :func:`release_staged`."""
    app = spark.sparkContext.applicationId
    path = f"{_root(spark).rstrip('/')}/holdfast-{app}/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(app, []).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as a scan of that copy."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession, since: int = 0) -> int:
    """Delete the copies this application staged, but for the first ``since`` of them; frames
    reading them become invalid. Spark has no public call to delete a path."""
    staged = _staged.get(spark.sparkContext.applicationId, [])
    paths, staged[since:] = staged[since:], []
    for path in paths:
        _delete(spark, path)
    return len(paths)


def release_path(spark: SparkSession, path: str) -> None:
    """Delete one copy before the others."""
    _staged[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged_here(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends, however it ends."""
    before = len(_staged.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_staged(spark, before)
