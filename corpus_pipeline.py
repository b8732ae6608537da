"""The training-corpus pipeline: each stage's kept documents are written and
become the next stage's input. A stage first removes the working tables of
those before it, whose results have been written by then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roasty.llm import decontamination, jaccard_join, pieces, quality, suffix_dedup
from roasty.llm.common import stored, table, working_tables

#: Folders of the working tables of the stages so far.
_WORKING: list[str] = []


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the adaptive rules keep."""
    with working_tables(spark, docs, _WORKING):
        return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the
    smallest id."""
    with working_tables(spark, docs, _WORKING):
        return jaccard_join.keep_one(docs)


#: Passages that documents share go if they have over 50 words. So many words
#: rarely take up fewer bytes than REPEATED; shorter passages stay, whatever
#: their bytes.
REPEATED, LEAST_WORDS = 200, 51


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; ``n_chars``
    follows the text. Documents of which nothing is left go."""
    with working_tables(spark, docs, _WORKING):
        return suffix_dedup.remove_duplicates(docs, length_col="n_chars", length=REPEATED, least_words=LEAST_WORDS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    with working_tables(spark, docs, _WORKING):
        return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their text, and whether decoding
    them gives the text back."""
    with working_tables(spark, docs, _WORKING):
        return pieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]

#: Piece encoding and the removal of repeated bytes have no SQL form; the
#: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
