"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import chunks, compression, conversations, decontamination, factorization, minhash
from holdfast.llm import parity, pieces, quality, runs, sharding, tokens, urlrules
from holdfast.llm.shipping import ship_package
from holdfast.sources.staging import staging_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    @functools.wraps(run)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = shipped
    return shipped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of linked groups: 3-word shingles, similarity of 85 % or more."""
    spec = minhash.NearDupSpec(shingle=3, percent=85)
    return minhash.near_duplicates(table(spark, folder, "documents"), spec)


@query
def op2_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per passage removed from a document: bytes of the old text, and the holder."""
    cleaned = chunks.deduplicate_passages(table(spark, folder, "documents"))
    return cleaned.select("doc_id", F.inline("removed_spans"))


@query
def op3_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; 1 is predicted from a score of 0.3 on."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = compression.fit_compression(docs, table(spark, folder, "labels"), "quality")
    return compression.score_quality(docs, model).select(
        "doc_id",
        compression.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


SITE_RULES = (
    urlrules.site_rule("org/", urlrules.ALLOW),
    urlrules.site_rule("example.org/es/", urlrules.BLOCK),
    urlrules.site_rule("example.org/en/1", urlrules.BLOCK),
    urlrules.site_rule("com/fr/", urlrules.ALLOW),
    urlrules.site_rule("com/de/", urlrules.BLOCK),
)
SPAM_WORDS = ("casino-win", "free-bets", "cheap-pills", "spam-farm")


@query
def op4_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url: site rules first, then rules on words of host and path."""
    rules = [*SITE_RULES, *(urlrules.word_rule(w, urlrules.BLOCK) for w in SPAM_WORDS)]
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages, rules).drop("url")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens, written to flat files and digested from what was read back."""
    written = tokens.write_tokens(
        table(spark, folder, "documents"),
        staging_path(spark, "tokens"),
        tokenizer_path("byte_bpe_50k.json"),
        end_id=2,
    )
    return tokens.read_tokens(spark, tokens.open_tokens(written.folder), digest=True)


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether base limits and rule cascade keep it."""
    return quality.cascade(table(spark, folder, "documents")).drop("rejected_by")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; 1 is predicted from a score of 0.5 on."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    machine = factorization.fit_machine(docs, table(spark, folder, "labels"), "toxic")
    return factorization.score_toxicity(docs, machine).select(
        "doc_id",
        compression.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards in random order, with row counts at most one apart."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, 24).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of documents that hold a benchmark item within 5 % of its length in edits."""
    return decontamination.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: number and hash of its ids, and whether the
    decoded text is the document's."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = pieces.decode_pieces(pieces.encode_pieces(docs, path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, least cost, edits and repaired text's hash of every damaged conversation."""
    return conversations.repair_conversations(conversations.damaged(table(spark, folder, "conversations")))


@query
def op12_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are 80 % similar or more."""
    return parity.similar_components(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs of periodic words, its strongest run, and its text without them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = runs.collapse_runs(docs, plant=True).withColumn("best", runs.strongest_run())
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        "runs_sha256",
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
