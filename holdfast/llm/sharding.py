"""Shards in random order by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters the records by a seeded hash, uniformly, into buckets that fit in memory.
Pass two collects each bucket, shuffles its array by Fisher and Yates (Spark's ``shuffle``),
and writes it. The place of a record in the whole order is its bucket's base, a prefix sum
of the bucket counts, plus its position in the bucket; the order is cut into shards whose
counts differ by one at most, so a bucket goes to few shards and slots have no gaps.

Records are dealt by their row number in the input as well as by their id, so that many
equal rows fill no bucket. The input is read twice and must give the same rows in the same
partitions both times, as a table does; ``write_shards`` fails if the passes disagree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.sources.staging import staging_path

BUCKET_BYTES = 32 << 20
FIXED_BYTES = 8


def text_size(text="text") -> F.Column:
    """UTF-8 bytes of the text (null: none) plus a fixed number for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + FIXED_BYTES


def write_shards(docs: DataFrame, shards: int, folder: str, seed: int = 1, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` in shuffled order as parquet, one subfolder per shard, and return the
    written table: all columns, ``size``, ``slot`` and ``shard``.

    Columns with these names are replaced. Every row is placed once, equal rows and null ids
    included; a null text has size 8. An empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = docs.sparkSession
    docs = docs.drop("size", "slot", "shard")
    rows, total = docs.agg(F.count(F.lit(1)), F.sum(text_size())).first()
    buckets = max(-(-(total or 0) // bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.monotonically_increasing_id())
    bucket = F.pmod(key, F.lit(buckets)).alias("bucket")

    # One row per bucket: the window's single task sees no documents.
    counts = docs.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scattered = docs.select(bucket, key.alias("key"), record.alias("record"))
    held = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("key", "record"))).alias("rows"))
    held = held.join(bases, "bucket")
    mixed = held.select("base", F.posexplode(F.shuffle("rows", seed)).alias("at", "row"))
    # The first ``more`` shards have one row more than the others.
    least, more = divmod(rows, shards)
    place, cut = F.col("base") + F.col("at"), more * (least + 1)
    rest = place - cut
    first = place < cut
    placed = mixed.select(
        "row.record.*",
        text_size("row.record.text").alias("size"),
        F.when(first, place % (least + 1)).otherwise(rest % max(least, 1)).cast("long").alias("slot"),
        F.when(first, F.floor(place / (least + 1)))
        .otherwise(more + F.floor(rest / max(least, 1)))
        .cast("int")
        .alias("shard"),
    )
    placed.write.partitionBy("shard").parquet(folder)
    fields = [f for f in placed.schema.fields if f.name != "shard"]
    schema = T.StructType([*fields, T.StructField("shard", T.IntegerType())])
    written = spark.read.schema(schema).parquet(folder)
    check = written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("top")).collect()
    if sum(c.n for c in check) != rows or any(c.n != c.top + 1 for c in check):
        raise RuntimeError("the input changed between the two passes; checkpoint it first")
    return written


def shard_documents(docs: DataFrame, shards: int, seed: int = 1, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """:func:`write_shards` into a new folder in shared storage."""
    return write_shards(docs, shards, staging_path(docs.sparkSession, "shards"), seed, bucket_bytes)
