"""Letter pairs are counted in every document, however many there are."""

import math

from pyspark.sql import functions as F

import corpus_pipeline
from chartmill.llm import secrets


def test_pairs_of_every_document(spark):
    n = 45_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "an").otherwise("AT").alias("text"))
    rare = spark.createDataFrame([(n + i, f"a{c}") for i, c in enumerate("bcdefg")], "doc_id long, text string")
    pairs = secrets.letter_pairs(docs.unionByName(rare)).first()["pairs"]
    bits = lambda seen: math.log2(26 * (seen + 1) / (n + 6 + 26))
    assert len(pairs) == 26
    for pair, seen in {"an": n // 3, "at": n - n // 3, **{f"a{c}": 1 for c in "bcdefg"}, "az": 0}.items():
        assert math.isclose(pairs[pair], bits(seen))


def test_pipeline_masks_by_pairs_of_every_document(spark):
    """The words that make the run of 26 letters text stand only in documents that a draw of every other one leaves out."""
    n, run = 45_000, "jacdtrbgnjtiewbkklemmoqmut"
    drawn = F.pmod(F.xxhash64(F.col("id"), F.lit("pairs")), F.lit(2)) == 0
    told = spark.range(n).select(F.col("id").alias("doc_id"), F.when(drawn, "of the").otherwise(f"{run[:14]} {run[13:]}").alias("text"))
    with_run = told.unionByName(spark.createDataFrame([(n, f"see {run} there")], "doc_id long, text string"))
    assert corpus_pipeline.secrets_masked(spark, with_run, "").where(f"doc_id = {n}").first()["text"] == f"see {run} there"
    elsewhere = told.select("doc_id", F.lit("of the").alias("text")).unionByName(with_run.where(f"doc_id = {n}"))
    assert corpus_pipeline.secrets_masked(spark, elsewhere, "").where(f"doc_id = {n}").first()["text"] == "see [SECRET] there"
