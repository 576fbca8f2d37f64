"""From raw documents to token ids: five stages, each on all that the one before it kept.

Every stage is a function of (session, documents, data folder). ``run`` writes each
stage's result to shared storage and gives the reread table to the next, so a lost executor
costs no more than the current stage, and no plan spans two stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import chunks, compression, decontamination, minhash, pieces
from holdfast.llm.queries import table, tokenizer_path
from holdfast.llm.shipping import ship_package
from holdfast.sources.staging import stage

# A document with a lower quality score goes.
LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    ship_package(spark)
    model = compression.fit_compression(docs, table(spark, sf_dir, "labels"), "quality")
    scored = compression.score_quality(docs, model).where(F.col("score") >= LEAST_QUALITY)
    return scored.select(*docs.columns) if "score" not in docs.columns else scored.drop("score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each near-duplicate group.

    Rows with the same doc_id are one document, of which one row stays. Rows without a
    doc_id belong to no group and stay."""
    ship_package(spark)
    found = minhash.near_duplicates(docs)
    verdict = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id"))
    verdict = verdict.agg(F.bool_and("kept").alias("__kept"), F.count(F.lit(1)).alias("__rows"))
    marks = verdict.where("NOT __kept OR __rows > 1")
    marked = docs.join(marks, F.col("doc_id") == F.col("__id"), "left")
    once = marked.where("__id IS NULL")
    repeated = marked.where("__kept").dropDuplicates(["__id"])
    return once.union(repeated).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller doc_id has; ``n_chars`` follows
    the text. A document of which nothing is left goes."""
    ship_package(spark)
    cut = chunks.deduplicate_passages(docs)
    changed = F.size("removed_spans") > 0
    cut = cut.where(~changed | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows without a doc_id go by their text."""
    ship_package(spark)
    text_key = F.concat(F.lit("text "), F.sha2("text", 256))
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("string"), text_key))
    leaks = decontamination.find_leaks(keyed, table(spark, sf_dir, "benchmark"), key="__key")
    return keyed.join(leaks.select("__key").distinct(), "__key", "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): token ids, and whether they decode to the text."""
    ship_package(spark)
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = pieces.encode_pieces(docs.select("doc_id", "text"), path)
    decoded = pieces.decode_pieces(encoded, path)
    same = F.col("decoded").eqNullSafe(F.col("text"))
    return decoded.select("doc_id", F.size("ids").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece_encoding", encoding),
]

# Models, hash bands and piece searches have no SQL form; the tests hold brute force beside.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
