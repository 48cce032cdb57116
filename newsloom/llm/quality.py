"""Operator 4, quality classifier with supervised subword embeddings.

A text is the mean of the learned vectors of its features: words, character n-grams of words, word pairs and how
lately a word stood in the text before, each hashed to a row of one embedding table. A softmax over the mean gives the label. Embedding and output weights are
trained together by stochastic gradient descent in numpy, in one task, over a bounded sample.

With two labels, what a feature adds to the outcome is one number, so executors get one number a row, and a word's
own sum is computed once in a worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import labelled
from newsloom.llm.words import WordTable, chunks, expand, held, trimmed

#: Rows and columns of the embedding, lengths of character n-grams, and passes over the sample.
BUCKETS, DIM, GRAMS, EPOCHS, RATE, BATCH = 1 << 18, 8, (3, 4), 6, 0.5, 32
#: Words whose n-grams are laid out at once.
WORDS_AT_ONCE = 20_000
#: Gradient steps that a small sample gets at least.
LEAST_STEPS = 400
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * _MIX
    return h ^ (h >> np.uint64(27))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words; feature rows of each word (itself and its character n-grams) and how many each has."""
    if len(words) > WORDS_AT_ONCE:
        parts = [word_features(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    marked = ["<" + w + ">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(words))
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(chars))
    rows, owner = [mix(own)], [np.arange(len(words))]
    for n in GRAMS:
        h = np.full(max(0, len(chars) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(1_000_003) + chars[k : len(chars) - n + 1 + k]
        inside = at[: len(h)] + n <= ends[: len(h)]
        rows.append(mix(h[inside]))
        owner.append(word[: len(h)][inside])
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    by = np.argsort(owner, kind="stable")
    return own, (rows[by] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owner, minlength=len(words)).astype(np.int64)


def pair_rows(hashes: np.ndarray) -> np.ndarray:
    """Feature rows of neighbouring words."""
    a, b = hashes[:-1], hashes[1:]
    return (mix(a * np.uint64(3) + b) % np.uint64(BUCKETS)).astype(np.int64)


def recency_rows(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Feature rows of how many words ago each word stood in its text before, in powers of two; one for a new word."""
    by = np.lexsort((doc, codes))
    again = np.zeros(len(by), bool)
    again[1:] = (codes[by[1:]] == codes[by[:-1]]) & (doc[by[1:]] == doc[by[:-1]])
    lag = np.zeros(len(by), np.int64)
    lag[by[again]] = by[again] - by[np.flatnonzero(again) - 1]
    step = np.where(lag > 0, np.floor(np.log2(np.maximum(lag, 1))) + 1, 0).astype(np.uint64)
    return (mix(step + np.uint64(0x5EED0000)) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class QualityModel:
    """What each feature row adds to the log odds of label 1, the intercept, and the curve from mean to score."""

    gain: np.ndarray
    bias: float
    slope: float
    intercept: float
    learned: bool = False

    def table(self) -> WordTable:
        """Per word: its hash, the sum of its features' gains, and their number, as three 64-bit values."""

        def make(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            own, rows, counts = word_features(words)
            sums = np.add.reduceat(self.gain[rows], np.cumsum(counts) - counts).astype(np.float64)
            return np.stack([own, sums.view(np.uint64), counts.astype(np.float64).view(np.uint64)], 1).ravel(), np.full(len(words), 3, np.int64)

        return WordTable(make, np.uint64)

    def logits(self, table: WordTable, texts: list[str]) -> np.ndarray:
        """Log odds of label 1 for whole texts; the intercept for a text without words."""
        lists = [t.split() for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        codes = table.codes([w for words in lists for w in words])
        values = table.values[: 3 * len(table.index)].reshape(-1, 3)
        own, sums, counts = (values[codes, k] for k in range(3))
        doc = np.repeat(np.arange(len(texts)), sizes)
        total = np.bincount(doc, sums.view(np.float64), len(texts))
        number = np.bincount(doc, counts.view(np.float64), len(texts))
        if len(own):
            total += np.bincount(doc, self.gain[recency_rows(codes, doc)], len(texts))
            number += sizes
            same = np.flatnonzero(doc[1:] == doc[:-1])
            total += np.bincount(doc[same], self.gain[pair_rows(own)][same], len(texts))
            number += np.bincount(doc[same], minlength=len(texts))
        return total / np.maximum(number, 1) + self.bias

    def scores(self, table: WordTable, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(table, texts) + self.intercept, -40, 40)))


def train(texts: list[str], labels: np.ndarray, totals: dict[int, int], *, seed: int = 7) -> QualityModel:
    """Learns the model from a sample; ``totals`` are the sizes of the classes that it stands for.

    Every fifth row is kept from the gradient and only shapes the curve from mean to score.
    """
    rng = np.random.default_rng(seed)
    table = np.ascontiguousarray(rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32))
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    labels = np.asarray(labels, np.int64)
    features = []
    index: dict[str, int] = {}
    lists = []
    for t in texts:
        words = t.split()
        lists.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
    own, flat, counts = word_features(list(index)) if index else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    starts = np.cumsum(counts) - counts
    for codes in lists:
        rows = np.r_[flat[expand(starts[codes], counts[codes])], pair_rows(own[codes]), recency_rows(codes, np.zeros_like(codes))].astype(np.int32)
        ids, number = np.unique(rows, return_counts=True)
        features.append((ids, (number / max(1, number.sum())).astype(np.float32)))
    del lists, index, flat
    learn = np.flatnonzero((np.arange(len(texts)) % 5 != 0))
    if len(texts) and labels.min() != labels.max():
        sides = [learn[labels[learn] == k] for k in (0, 1)]
        few = min(sides, key=len)
        more = max(map(len, sides)) - len(few)  # of a rare label rows are taken again, so that both weigh the same
        learn = np.concatenate([learn, np.resize(few, more)]) if len(few) else learn
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(learn)))
        steps = epochs * -(-len(learn) // BATCH)
        done = 0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(learn), -(-len(learn) // BATCH)):
                rate = RATE * (1 - done / steps)
                done += 1
                ids = np.concatenate([features[i][0] for i in batch])
                part = np.concatenate([features[i][1] for i in batch])
                sizes = np.array([len(features[i][0]) for i in batch])
                doc = np.repeat(np.arange(len(batch)), sizes)
                mean = np.zeros((len(batch), DIM), np.float32)
                np.add.at(mean, doc, table[ids] * part[:, None])
                z = mean @ out + bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(batch)), labels[batch]] -= 1
                back = p @ out.T
                np.subtract.at(table, ids, rate * part[:, None] * back[doc])
                out -= rate * mean.T @ p
                bias -= rate * p.mean(0)
    model = QualityModel((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, len(texts) > 0 and labels.min() != labels.max())
    aside = np.flatnonzero(np.arange(len(texts)) % 5 == 0)
    if len(aside):
        sampled = {k: max(1, int((labels == k).sum())) for k in (0, 1)}
        weights = np.array([totals.get(int(k), 1) / sampled[int(k)] for k in labels[aside]])
        model.slope, model.intercept = labelled.platt(model.logits(model.table(), [texts[i] for i in aside]), labels[aside], weights)
    return model


def score(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of every whole text: ``doc_id, score``, from 0 to 1, higher for label 1.

    A null text counts as empty and gets the score of the intercept. Repeated rows and null ids are scored as they
    are; other columns are left out, so their names cannot clash; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = held(name, lambda: (shared.value, shared.value.table()))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own.scores(table, texts[a:b]), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(trimmed(run), f"doc_id {kind}, score double")


def keep(docs: DataFrame, model: QualityModel, least: float, *, text: str = "text") -> DataFrame:
    """Rows whose score is ``least`` or more, with all their columns; a null text is scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name, at = uuid.uuid4().hex, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = held(name, lambda: (shared.value, shared.value.table()))
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            good = [own.scores(table, texts[a:b]) >= least for a, b in chunks(texts)]
            yield batch.filter(pa.array(np.concatenate(good))) if good else batch

    return docs.mapInArrow(trimmed(run), docs.schema)


def fit(docs: DataFrame, labels: DataFrame, *, parts: int = 4, held: int = 2, per_class: int = labelled.PER_CLASS) -> QualityModel:
    """Trains on a sample of the rows whose fold is not held out, ``per_class`` rows of each label at most."""
    rows, totals = labelled.sample(docs, labels, "quality", parts, held, per_class=per_class)
    return labelled.train_on_executor(rows, lambda texts, marks: train(texts, marks, totals))
