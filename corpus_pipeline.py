"""A corpus cleaned in five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagia.llm import decontam, exact_dedup, near_dedup, sp_tokens, toxicity
from pelagia.llm.queries import piece_model, table
from pelagia.sources.scratch import save, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7, by a scorer that learns from `labels` of the documents given; null and empty texts are scored as empty ones."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the smallest id; a null text equals an empty one, a missing id counts as smallest."""
    return exact_dedup.keep_one(docs, keep="min")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (linked by SimHash fingerprints and by shingles, five-word sets at similarity 0.8 or more) the document with the smallest id; texts without words and rows without id stay."""
    return near_dedup.keep_one(docs, words=5, similarity=0.8)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`, in its words or with other values; null and empty texts and rows without id stay."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=8, min_share=0.3)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text and the text decoded from them; a null text is an empty one."""
    return sp_tokens.encode(docs, piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("tokens", tokenize),
]

#: SQL expresses neither the trained scorer nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and read again.

    Each takes all rows and columns that its predecessor kept, whatever other columns there
    are; repeated rows are exact copies; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        save(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
