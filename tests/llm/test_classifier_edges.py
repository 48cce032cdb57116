"""Classifiers without labels, texts or rows."""

import pytest

from newsloom.llm import labelled, quality, toxicity

DOCS = [(1, "a b"), (2, None), (None, "x"), (1, "a b")]


@pytest.mark.parametrize("module", [quality, toxicity])
@pytest.mark.parametrize("labels", [[], [(1, 0, 1), (2, 1, 0), (None, 1, 1)], [(1, 1, 1)]])
def test_scores_exist_for_every_row(spark, module, labels):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    model = module.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = module.score(docs, model).collect()
    assert len(rows) == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(docs.limit(0), model).count() == 0


def test_sample_leaves_held_out_rows_alone(spark):
    from pyspark.sql import functions as F

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    rows, totals = labelled.sample(docs, labels, "quality", 4, 2, per_class=30)
    rows = rows.toPandas()
    held = {r["doc_id"] for r in docs.where(labelled.fold(F.col("doc_id"), 4, 2)).collect()}
    assert not held & set(rows["id"]) and (rows["label"].value_counts() == 30).all() and sum(totals.values()) == 400 - len(held)


def test_keep_retains_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id long, text string, lang string")
    model = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.keep(docs, model, 0.4).collect() == docs.collect()
    assert quality.keep(docs, model, 0.6).count() == 0
