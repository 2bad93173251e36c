"""A corpus from raw documents to training blocks: five stages, each written as Parquet before the next reads it.

1. language ID: documents in no known language go;
2. SimHash near-duplicates: one document of each group stays;
3. decontamination: documents with benchmark passages go;
4. secret scan: secrets are masked in the text, every document stays;
5. mixing: the words are packed into blocks, and sources mixed to their target weights.

Stages 1 to 4 return the columns of documents; stage 5 returns the pieces of the mixed blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartmill.llm import decontam, langid, mixing, secrets, simhash
from chartmill.llm.shared import written


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, shingle=3, distance=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_blocks(docs)


STAGES = [
    ("language_id", in_known_language),
    ("simhash_near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scan", secrets_masked),
    ("mixing", mixed),
]

#: Fingerprints, hashed trigrams and hashed draws have no SQL; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
