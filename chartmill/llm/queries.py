"""The registered queries of these operators, each over its whole table, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.llm import caps, decontam, digests, html_text, langid, lexical, licences, lm, mixing, preference, repair, secrets, simhash
from chartmill.llm.oracles import SQL
from chartmill.llm.shared import new_folder

__all__ = ["QUERIES", "SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"), fdr=0.1)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rounded, as sums in another order differ in the last places.
    exact = lm.scores(table(spark, sf_dir, "documents"))
    return exact.withColumns({c: F.round(c, 6) for c in ("base_score", "score")}).drop("perplexity")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preference.records(preference.in_pairs(table(spark, sf_dir, "conversations")))
    spans = lambda mask: F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",").alias(mask)
    return rows.select("pair_id", "piece", "sides", "prompt", "chosen", spans("chosen_mask"), "rejected", spans("rejected_mask"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = digests.DigestIndex.create(spark, new_folder(spark, "digests"), digests.buckets_for(docs))
    return index.decide(digests.add_newest_first(docs, index))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided, _ = repair.repairs(repair.damaged(table(spark, sf_dir, "conversations")))
    return decided


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_lm_scoring, op3_embedding_dedup, op4_language_id, op5_chat_preference, op6_decontamination, op7_simhash_dedup,
        op8_html_extraction, op9_licence_scan, op10_mixing, op11_exact_dedup, op12_lexical_search, op13_conversation_repair, pipeline,
    )
}
