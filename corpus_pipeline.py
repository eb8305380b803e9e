"""The training-data pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All stages but the last
return the columns of documents; what a stage returns is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmill.llm import decontaminate, exact_dedup, language_id, packing, simhash
from postmill.llm.common import read
from postmill.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the calibrated model does not reject."""
    scored = language_id.predict(docs, language_id.fit(docs), lang_as="__lang", score_as="__score", rejected_as="__rejected")
    return scored.where("not __rejected").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints."""
    return simhash.keep_representatives(docs, shingle=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin, offset and the bin's capacity."""
    return packing.pack_documents(docs).withColumnRenamed("row", "copy")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

# SQL can express neither the trained language model nor the packing; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
