"""Bounded samples of labelled documents, and training on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import held, trimmed

#: Rows of each class that a model is trained on, and the longest text among them.
PER_CLASS, MAX_CHARS = 2000, 20_000


def fold(doc_id: Column, parts: int, held: int) -> Column:
    """Whether a row is held out: crc32 of its doc_id as text, modulo ``parts``, is ``held``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == held, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, *, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """Rows ``id, text, label`` of a training sample, and how many labels each class has in all.

    Held-out rows are never read. Of each class the documents that come first in the order of a hash of their id are
    taken, ``per_class`` at most, so the sample is the same at every run; texts over ``max_chars`` are left to the
    other rows. Rows without a label of 0 or 1, without an id or without a text teach nothing, nor do labels of
    documents that are not there. Of an id with several texts the one with the smallest hash is taken.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).where(~fold(F.col("id"), parts, held)).distinct()
    totals = {int(r["label"]): int(r["count"]) for r in known.groupBy("label").count().collect()}
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull() & (F.length("text") <= max_chars))
    texts = texts.select("id", "text", F.xxhash64("text").alias("t"))
    there = texts.select("id", "t").where(~fold(F.col("id"), parts, held)).groupBy("id").agg(F.min("t").alias("t")).join(known, "id")
    chosen = None
    for value in (0, 1):
        first = there.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = first if chosen is None else chosen.unionByName(first)
    rows = texts.join(F.broadcast(chosen), ["id", "t"])  # the broadcast has 2 * per_class rows at most
    return rows.dropDuplicates(["id", "t", "label"]).select("id", "text", "label"), totals


def train_on_executor(rows: DataFrame, train: Callable[[list[str], np.ndarray], object]) -> object:
    """What ``train(texts, labels)`` returns for a sample, computed in one task; the sample never reaches the driver.

    The sample is bounded, so the task is; if its executor is lost, the task is done again and gives the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        marks = np.zeros(0, np.int32)
        if own := [b for b in batches if b.num_rows]:
            table = pa.Table.from_batches(own).sort_by([("at", "ascending"), ("t", "ascending"), ("label", "ascending")])
            texts, marks = table.column("text").to_pylist(), table.column("label").to_numpy()
        made = pickle.dumps(held("training", lambda: train)(texts, marks))
        del texts, marks, own
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["model"])

    one = rows.select("text", "label", F.xxhash64("id", F.lit(3)).alias("at"), F.xxhash64("text").alias("t")).repartition(1)
    made = one.mapInArrow(trimmed(run), "model binary").first()
    return pickle.loads(made["model"]) if made else train([], np.zeros(0, np.int32))  # nothing to learn from


def platt(scores, labels, weights, rounds: int = 200) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through scores, by Newton steps with a little shrinkage."""
    x, y, w = (np.asarray(v, float) for v in (scores, labels, weights))
    if not len(x) or y.min() == y.max():
        return 1.0, 0.0
    scale = max(1e-9, float(np.abs(x).max()))
    x = x / scale
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # keeps the curve finite
    a = b = 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (p - target) * x).sum() + 1e-3 * a, (w * (p - target)).sum()])
        h = w * p * (1 - p)
        m = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if float(np.abs(step).max()) < 1e-8:
            break
    return float(a / scale), float(b)
