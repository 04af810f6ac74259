"""Preparation of a training corpus in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it has kept; its result is written as Parquet in the shared folder and read
again, so a lost executor never repeats an earlier stage; its input and what it
was made from are deleted then. All stages but the
last return the columns of ``documents``. The operators' own modules say how
nulls, empty and repeated rows are treated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tirepulse.llm import decontaminate, packing, quality, simhash_near_dup, suffix_dedup
from tirepulse.llm.store import discard_all, recorded, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more, as ``labels.quality`` marks good ones."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each SimHash group."""
    return simhash_near_dup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that also start earlier."""
    return suffix_dedup.keep_first_text(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: SQL expresses neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the result of the last one."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with recorded() as made:
            docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        discard_all(spark, before + made[:-1])
        before = made[-1:]
    return docs
