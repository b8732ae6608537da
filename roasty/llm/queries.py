"""The operators as registered queries over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roasty.llm import (
    byte_bpe,
    centroids,
    chat,
    decontamination,
    html_extraction,
    jaccard_join,
    merkle,
    pieces,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from roasty.llm.common import table
from roasty.llm.oracle_sql import ORACLE_SQL


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("text_key")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the digest columns ``text``, what is left of each document."""
    done = suffix_dedup.dedup(table(spark, sf_dir, "documents"), with_text=True)
    return done.drop("kept", "text_key").withColumnRenamed("kept_text", "text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs)
    return coded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "round_trip")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "node")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as flat transcripts, parsed back into turns by a model
    fitted on three in four of them."""
    parts = chat.as_transcript(table(spark, sf_dir, "conversations"))
    return chat.parse(parts, chat.fit(parts.filter(chat.fitted(F.col("conv_id")))))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after edits derived from the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    built = token_counts.build(token_counts.derived_edits(docs)).withColumn("n_edits", F.size("edits").cast("long"))
    built = built.withColumn("n_tokens_before", F.col("n_tokens"))
    done = token_counts.apply_edits(built)
    return done.select(
        "doc_id", "n_edits", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"),
        F.char_length("text").cast("long").alias("n_chars_after"), "encoded_chars", F.size("tree").cast("long").alias("n_segments"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url", "complete")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("proof")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_html_extraction": op5_html_extraction,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_counts": op7_token_counts,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE: dict[str, str] = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
