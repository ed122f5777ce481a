"""Registered queries of the training-data operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, decontam, hilbert, html_main, kneser_ney, langid, line_dedup, merkle, mixing, near_dup, passages, secret_scan, sharding
from tidemark.llm.common import table


def op1_random_walk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row for each document and item."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op2_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot (law ``bytes``)."""
    out = sharding.shard_digest(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op4_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words or more, one row for each document and passage."""
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop("text_key")


def op5_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document."""
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    return hilbert.neighbours_of_every(table(spark, sf_dir, "embeddings"))


def op7_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the two thirds that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers that every document loses to an earlier similar line."""
    return line_dedup.duplicate_lines(table(spark, sf_dir, "documents")).drop("row")


def op10_probminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_docs", (F.col("row") == F.col("class_row")).alias("kept"))


def op11_stream_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two to five words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability by a model of the documents that aren't held out."""
    return kneser_ney.score_held_out(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, with the root that its tampered form leads to."""
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_random_walk_decontamination, op2_prefix_sum_shards, op3_wrapper_induction, op4_compact_window_passages, op5_hash_threshold_mix,
        op6_hilbert_neighbours, op7_structural_secrets, op8_naive_bayes_language, op9_fuzzy_lines, op10_probminhash_near_duplicates,
        op11_stream_collocations, op12_kneser_ney_scores, op13_merkle_manifest,
    )
}
ORACLE = {"op5_hash_threshold_mix": mixing.MIX_SQL, "op11_stream_collocations": collocations.COLLOCATIONS_SQL, "op13_merkle_manifest": merkle.MANIFEST_SQL}
