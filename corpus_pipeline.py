"""The corpus pipeline: documents in, documents that are fit for training out, encoded as pieces.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written and read again before the next one. All
stages but the last return the columns of documents. Defined cases are those of the operators: null and empty
texts pass through every stage as what they are, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from serieskit.llm import decontaminate, near_dup, pieces, suffix_dedup, toxicity
from serieskit.llm.common import load, stored
from serieskit.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return toxicity.keep_civil(docs, load(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: 0.8 of their five-word shingles."""
    return near_dup.drop_near_duplicates(docs, words=5, percent=80)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur more than once."""
    return suffix_dedup.drop_repeats(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"), unnamed=True)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip of every document that is left."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", suffix_stage),
    ("decontaminate", benchmark_stage),
    ("pieces", pieces_stage),
]

# Boosted trees, edit distances and merges of pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
