"""Registered queries of the operators of this folder, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tirepulse.llm import (
    collision_ann, decontaminate, embedding_near_dup, filter_audit, language_id, license_scan, packing, quality, sharding,
    simhash_near_dup, spelling, substring_dedup, suffix_dedup,
)
from tirepulse.llm.oracle import ORACLE  # noqa: F401  DuckDB SQL of the queries that SQL can express


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(_table(spark, sf_dir, "documents")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


def op6_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs, ~quality.held_out()))
    return found.select("doc_id", quality.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padding")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dup.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_sharding, op3_suffix_dedup, op4_license_scan, op5_substring_dedup, op6_simhash_near_dup, op7_language_id, op8_packing, op9_nearest_neighbours, op10_quality,
    op11_filter_audit, op12_spelling_variants, op13_embedding_near_dup)}
