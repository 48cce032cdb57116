"""The stages in a row, each against what it may and has to do."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm.storage import written
from tests.llm.test_free import shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert len(corpus_pipeline.STAGES) == 5


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = (s.join(labels, "doc_id").groupBy("quality").count().collect() for s in stages[:2])
    before, after = ({r["quality"]: r["count"] for r in x} for x in (before, after))
    assert after.get(1, 0) >= 0.97 * before[1] and after.get(0, 0) <= 0.1 * before.get(0, 1)


def test_line_stage(stages):
    before, after = ({r["doc_id"]: r for r in s.collect()} for s in stages[1:3])
    assert before.keys() == after.keys()
    seen = set()
    for d in sorted(after):
        assert after[d]["n_chars"] == len(after[d]["text"])
        for line in after[d]["text"].split("\n"):
            if len(line) >= 30:
                assert line not in seen
                seen.add(line)


def test_near_duplicates_stage(stages):
    before, after = ({r["doc_id"]: shingles(r["text"]) for r in s.collect()} for s in stages[2:4])
    ids = sorted(after)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            assert not (after[a] and after[b] and 100 * len(after[a] & after[b]) >= 75 * len(after[a] | after[b]))
    for d in before.keys() - after.keys():
        assert any(e < d and before[e] and 100 * len(before[d] & before[e]) >= 75 * len(before[d] | before[e]) or e in before.keys() - after.keys() for e in before)


def test_decontamination_stage(spark, stages):
    squeeze = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [squeeze(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in squeeze(r["text"]) for r in stages[4].collect() for i in items)


def test_tokens_stage(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].where(F.col("decoded_sha256").isNull()).count() == 0
