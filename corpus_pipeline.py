"""A corpus pipeline of five operators: quality, exact copies, near copies, benchmark leaks,
tokens. Every stage gets what the one before kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamledger.llm import bpe, decontaminate, exact, near, quality
from streamledger.llm.common import concluded, materialise, read_table
from streamledger.llm.tokenizers import tokenizer_file


def _without(docs: DataFrame, dropped: DataFrame, by_text: bool = False) -> DataFrame:
    """``docs`` without the rows named in ``dropped`` (``__drop_id`` and, with ``by_text``,
    ``__drop_text``: a hash of the text); all columns stay, a NULL identifier is a value."""
    same = F.col("doc_id").eqNullSafe(F.col("__drop_id"))
    if by_text:
        same = same & (F.xxhash64("text") == F.col("__drop_text"))
    return docs.join(dropped.distinct(), same, "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    verdict = concluded(lambda: quality.classify(docs, read_table(spark, sf_dir, "labels")).where(~F.col("kept")).select("doc_id", "text_hash"), "rejected")
    return _without(docs, verdict.select(F.col("doc_id").alias("__drop_id"), F.col("text_hash").alias("__drop_text")), by_text=True)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest identifier stays, once."""
    verdict = concluded(lambda: exact.exact_dedup(docs, keep="max").where(~F.col("kept")), "copies")
    same_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    text_of = docs.select(F.col("doc_id").alias("__drop_id"), F.xxhash64("text").alias("__drop_text"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("s"))
    named = verdict.where(~same_id).select(F.col("doc_id").alias("__v"), F.col("text_sha256").alias("s")).distinct()
    dropped = text_of.join(named, F.col("__drop_id").eqNullSafe(F.col("__v")) & (text_of["s"] == named["s"]), "left_semi")
    left = _without(docs, dropped.select("__drop_id", "__drop_text"), by_text=True)
    repeated = verdict.where(same_id).select(F.col("doc_id").alias("__drop_id")).distinct()
    if repeated.isEmpty():
        return left
    # rows that repeat identifier and text
    again = left.join(repeated, F.col("doc_id").eqNullSafe(F.col("__drop_id")), "left_semi")
    once = again.withColumn("__text", F.coalesce("text", F.lit(""))).dropDuplicates(["doc_id", "__text"]).drop("__text")
    return _without(left, repeated).unionByName(once)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest identifier."""
    verdict = concluded(lambda: near.near_duplicates(docs, words=5, percent=80).where(~F.col("kept")).select("doc_id"), "near-copies")
    return _without(docs, verdict.select(F.col("doc_id").alias("__drop_id")))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    leaks = concluded(lambda: decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "leaks")
    return _without(docs, leaks.select(F.col("doc_id").alias("__drop_id")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, and the check that they decode to its text."""
    coded = bpe.encode_documents(docs, tokenizer_file(), decode=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("byte_bpe", token_stage),
]

#: The quality, near-duplicate, retrieval and token stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
