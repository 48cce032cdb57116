"""The corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, tokenization.

Each stage takes the documents that the one before it kept, and works on all of them. Stages of one run are written
as Parquet to the shared folder and read back, so a lost executor repeats part of one stage and nothing before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontaminate, jaccard, line_dedup, quality, sentencepiece_bpe
from newsloom.llm.catalog import PREDICT_FROM, small_batches, table, tokenizer
from newsloom.llm.storage import written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score predicts label 0. The model learns from the labelled table of the corpus.

    Null texts are scored as empty ones. Without labels of both kinds nothing is known against a document and all stay.
    """
    small_batches(spark)
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), parts=4, held=2)
    return quality.keep(docs, model, PREDICT_FROM) if model.learned else docs


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat an earlier one within two edits, or exactly if they are short; every document stays,
    with its new length. A null text stays null, and so does its length."""
    cleaned = line_dedup.remove(docs, line_dedup.repeated_lines(docs, short=True))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of similar documents. Null and empty texts are similar to
    nothing and stay, as do rows without an id."""
    small_batches(spark)
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, edits included; with an empty benchmark all stay."""
    small_batches(spark)
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and checksums of what is left, encoded and decoded with the 32k piece model; a null text has none."""
    small_batches(spark)
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode_decode(docs, tokenizer("piece_bpe_32k.model")))


STAGES = [
    ("quality_filter", quality_filter),
    ("line_repeats", line_repeats),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Trained models and LSH are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
