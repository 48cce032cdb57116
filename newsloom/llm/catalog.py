"""The queries of this subpackage by name, with their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import ann, decontaminate, jaccard, labelled, line_dedup, lm_scoring, pii, prefix_trie, quality, sentencepiece_bpe, sql, token_files, toxicity, vector_codes
from newsloom.llm.url_filter import filter_urls

#: Fixed values of the url rules.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch, for whole texts; a session that has set its own number keeps it.

    Spark reads the setting when a plan is run, after the query has returned it, so it stays set.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with the group that similar sets of five-word shingles make.

    Null and empty texts have no shingles and are groups of their own; copies are one group; an empty table gives none.
    """
    small_batches(spark)
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded with the 32k piece model, as lengths and checksums.

    A null text is an empty one, which has no ids; repeated rows are encoded each.
    """
    small_batches(spark)
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document of ``documents`` holds, with its place and its edits.

    Null and empty texts hold nothing, items without words are held by none; of equally good places the first counts;
    with an empty ``benchmark`` the result is empty.
    """
    small_batches(spark)
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A row is predicted to have label 1 from this score on.
PREDICT_FROM = 0.7


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scored by the quality classifier, learned from the folds that are not held out.

    A null text is scored as an empty one; a null id is in no fold; without labels of both kinds all scores are alike.
    """
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), parts=4, held=2))
    return scored.select("doc_id", labelled.fold(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with the numbers of its lines that an earlier line of the corpus repeats.

    A null text has no lines; blank lines repeat nothing; of equal rows the first in the order of ids is the earlier one.
    """
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"), short=True).select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("repeats").cast("long").alias("n_repeats"), F.array_join(F.col("repeats").cast("array<string>"), ",").alias("repeats"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scored by the random field, with the offsets of the words that offend.

    Null and empty texts have the lowest score and no spans; a null id is in no fold; without labels nothing is toxic.
    """
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), parts=3, held=1))
    return scored.select("doc_id", labelled.fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), "spans")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as token ids in coded files, read back from them as offsets and checksums.

    A null text is an empty one, whose only id is the end; repeated ids stand side by side, null ones first.
    """
    small_batches(spark)
    folder = token_files.encode_to_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)
    return token_files.digests(token_files.read_tokens(spark, folder))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every vector of ``embeddings`` whose id is divisible by 100.

    Vectors that are null, zero or hold null or non-finite components take no part; ties go to the smaller id; with
    fewer candidates all of them are returned, and an empty table gives none.
    """
    small_batches(spark)
    return ann.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``, with the terms that give it away.

    A null text is an empty one and has no spans; equal texts have equal spans.
    """
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of ``pages`` judged by its own rule, or else by what its redirect aliases hand on.

    A null address, or one without a scheme, has an empty host and path and no aliases; a null page has no links.
    """
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` as codes of 16 parts against trained codebooks of 64 entries, with its error.

    Vectors that are null or hold null or non-finite components are left out; null labels are one label.
    """
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` with its log10 probability, learned from the documents that are not held out.

    A null text is an empty one; its only token is the end.
    """
    small_batches(spark)
    return lm_scoring.score(table(spark, sf_dir, "documents"), parts=7, held=2)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie that the rebuilt ``conversations`` make, with members, children, leaves and savings.

    Null roles and texts are empty; a null turn comes first; an empty table has no nodes.
    """
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
