"""Queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal.llm import (ann, bpe, convrepair, decontam, hardneg, licenses, linededup, maxent, pii, sharding, simhash,
                         spotsigs, toxicity)
from cafetal.llm.common import table


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), k=20)


def vocabulary() -> str:
    """The tokenizer file; it is a parameter of the operator and not kept here."""
    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(),
                                ("ids_sha256", "decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(toxicity.fold() != 0))
    return (toxicity.score(docs, model)
            .select("doc_id", (F.coalesce(toxicity.fold(), F.lit(1)) == 0).alias("held_out"), "score", "predicted"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"), shingle=3, bits=2)


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(linededup.dedup_lines(table(spark, sf_dir, "documents")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shard(table(spark, sf_dir, "documents")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_learned_partitions, op2_bpe, op3_toxicity, op4_pii, op5_simhash, op6_maxent_lm, op7_line_dedup, op8_license_scan, op9_decontaminate, op10_histogram_shards,
                                      op11_conversation_repair, op12_hard_negatives, op13_spotsigs)}


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": linededup.ORACLE, "op11_conversation_repair": convrepair.ORACLE, "op12_hard_negatives": hardneg.ORACLE, "op13_spotsigs": spotsigs.ORACLE}
