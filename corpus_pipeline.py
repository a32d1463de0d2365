"""The corpus pipeline: from raw documents to the token ids of clean, distinct, uncontaminated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal.llm import bpe, decontam, linededup, simhash, toxicity
from cafetal.llm.common import fresh, materialise, table
from cafetal.llm.registry import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones rejects go."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(toxicity.fold() != 0))
    return toxicity.keep_clean(docs, model)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them; ``n_chars`` follows the text."""
    return (linededup.dedup_lines(docs)
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    leak, digest = fresh(docs, "__leak", "__leak_text")
    leaks = found.filter("contaminated").select(F.col("doc_id").alias(leak), F.col("text_hash").alias(digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(leak)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(digest))
    return docs.join(leaks, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the decoded text."""
    return bpe.encode_documents(docs, vocabulary(), ("ids", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_shared_lines), ("simhash", drop_near_duplicates),
          ("decontaminate", drop_leaks), ("bpe", encode)]

# Trained models, 64-bit hashes of words and a tokenizer can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
