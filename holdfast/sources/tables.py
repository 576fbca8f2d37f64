"""Persisted tables between stages: parquet by default, CSV with a header on request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "csv")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    single_file: bool = False,
) -> str:
    """Overwrite ``path`` with ``df`` and return the path.

    A partitioned write is rebalanced on the partition column first, so that a task
    writes to few folders and adaptive execution cuts a large month into several
    evenly sized files. ``single_file`` is for reports of a few rows.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown table format {fmt!r}; known: {list(FORMATS)}")
    if partition_by:
        df = df.hint("rebalance", partition_by)
    elif single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """Read a table written by :func:`write_table`, columns in the order of ``schema``."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown table format {fmt!r}; known: {list(FORMATS)}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    return df.select(*schema.fieldNames())
