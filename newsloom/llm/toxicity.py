"""Operator 6, toxicity by a linear-chain conditional random field over words.

Documents carry the labels, so the words of the training sample are labelled first: a word or a word beginning that
occurs in toxic documents and practically never in others marks a toxic word. A two-state field is then trained on
these labelled words by gradient steps from forward-backward marginals. Applied to whole texts, the marginals of
all words make a document's score and the offsets of the words that offend.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import labelled
from newsloom.llm.quality import mix
from newsloom.llm.words import WordTable, chunks, held, trimmed

#: Rows of the weight table; lengths of word beginnings and endings; passes, rate and documents in a gradient step.
BUCKETS, STARTS, ENDS, EPOCHS, RATE, BATCH = 1 << 18, tuple(range(3, 9)), (2, 3), 8, 0.3, 64
#: A word is evidence if it is in so many toxic documents at least, and so often in toxic rather than in other ones.
EVIDENCE_DOCS, EVIDENCE_SHARE = 5, 0.98
#: What is in this part of all toxic documents is a mark by itself; anything rarer only where no other explains a document.
EVIDENCE_PART = 0.01
#: Bounds of a document's evidence in log odds, words that make it, and what a word counts for at least.
FLOOR, MOST, FAINT = 4.0, 3, -2.0
#: Words side by side in the blocks of a scan.
SCAN = 64
EDGES = re.compile(r"^\W+|\W+$")


def normal(word: str) -> str:
    """A word in lower case without punctuation around it."""
    return EDGES.sub("", word.lower())


def cues(word: str) -> list[str]:
    """Strings that stand for a word's features: itself, its beginnings and its endings."""
    w = normal(word)
    return ["=" + w, *(f"^{w[:n]}" for n in STARTS if len(w) > n), *(f"{w[-n:]}$" for n in ENDS if len(w) > n)]


def feature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows of words and how many each has."""
    lists = [cues(w) for w in words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(c) for cs in lists for c in cs), np.uint64)
    return (mix(hashes) % np.uint64(BUCKETS)).astype(np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


def evidence(texts: list[str], labels: np.ndarray) -> set[str]:
    """Words (``=word``) and word beginnings (``^begin``) that mark toxic documents.

    Marks are taken one by one, each time the one in most toxic documents that none explains yet, so that what
    merely stands beside a mark, or is copied along with it, is not taken for one itself.
    """
    toxic: dict[str, list[int]] = {}
    other: Counter = Counter()
    n_toxic, n_other = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    for i, (text, label) in enumerate(zip(texts, labels, strict=True)):
        found = {c for w in set(text.split()) for c in cues(w) if c[0] in "=^" and len(c) > 1}
        if label:
            for c in found:
                toxic.setdefault(c, []).append(i)
        else:
            other.update(found)
    least = max(EVIDENCE_DOCS, round(EVIDENCE_PART * n_toxic))
    good = {c: set(d) for c, d in toxic.items() if len(d) >= EVIDENCE_DOCS and len(d) / n_toxic >= EVIDENCE_SHARE * (len(d) / n_toxic + other[c] / n_other)}
    marks = {c for c, d in good.items() if len(d) >= least}
    left = set().union(*good.values()) if good else set()
    for c in marks:
        left -= good[c]
    rest = {c: d for c, d in good.items() if c not in marks}
    while rest:
        rest = {c: own for c, d in rest.items() if len(own := d & left) >= EVIDENCE_DOCS}
        if rest:
            best = max(rest, key=lambda c: (len(rest[c]), c))
            marks.add(best)
            left -= rest.pop(best)
    return marks


def ratios(gain: np.ndarray, first: np.ndarray, move: np.ndarray, prior: float) -> np.ndarray:
    """Forward odds of the toxic state at every position of sequences laid end to end.

    gain: odds that a position's own features give. first: where a sequence begins. move: 2 x 2 weights from state
    to state. Each position maps the odds before it by a fraction a r + b over c r + d; the maps of a block are
    composed for all blocks at once, then the blocks are chained.
    """
    n = len(gain)
    if not n:
        return np.zeros(0)
    wide = -(-n // SCAN) * SCAN
    a, b, c, d = np.zeros(wide), np.ones(wide), np.zeros(wide), np.ones(wide)
    a[:n] = np.where(first, 0, move[1, 1] * gain)
    b[:n] = np.where(first, prior * gain, move[0, 1] * gain)
    c[:n] = np.where(first, 0, move[1, 0])
    d[:n] = np.where(first, 1, move[0, 0])
    a, b, c, d = (np.ascontiguousarray(x.reshape(-1, SCAN).T) for x in (a, b, c, d))
    for j in range(1, SCAN):
        pa_, pb, pc, pd_ = a[j - 1], b[j - 1], c[j - 1], d[j - 1]
        na, nb = a[j] * pa_ + b[j] * pc, a[j] * pb + b[j] * pd_
        nc, nd = c[j] * pa_ + d[j] * pc, c[j] * pb + d[j] * pd_
        s = 1 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        a[j], b[j], c[j], d[j] = na * s, nb * s, nc * s, nd * s
    r, into = 0.0, np.zeros(a.shape[1])
    la, lb, lc, ld = (x[-1].tolist() for x in (a, b, c, d))
    for k in range(a.shape[1]):
        into[k] = r
        r = (la[k] * r + lb[k]) / (lc[k] * r + ld[k])
    return ((a * into + b) / (c * into + d)).T.ravel()[:n]


def marginals(gain: np.ndarray, sizes: np.ndarray, move: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of the toxic state at every position, and the forward and backward odds behind it."""
    sizes = sizes[sizes > 0]
    ends = np.cumsum(sizes)
    first = np.zeros(len(gain), bool)
    first[ends - sizes] = True
    last = np.zeros(len(gain), bool)
    last[ends - 1] = True
    ahead = ratios(gain, first, move, prior)
    # Backward odds times own odds follow the same kind of map from the right, with the weights transposed.
    behind = ratios(gain[::-1], last[::-1], move.T, 1.0)[::-1] / gain
    odds = ahead * behind
    return odds / (1 + odds), ahead, behind


def none_toxic(ahead: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Probability that no word of a document is toxic, from the forward odds; short of one by a millionth at least."""
    ends = np.cumsum(sizes)
    step = np.log(move[0, 0]) - np.log(move[0, 0] + ahead * move[1, 0])
    step[ends - 1] = -np.log1p(ahead[ends - 1])
    return np.minimum(np.exp(np.add.reduceat(step, ends - sizes)), 1 - 1e-6)


@dataclass
class ToxicityModel:
    """Weights of feature rows and of state changes, and the curve from a document's evidence to its score."""

    weight: np.ndarray
    move: np.ndarray
    prior: float
    slope: float = 1.0
    intercept: float = 0.0

    def table(self) -> WordTable:
        def make(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            rows, counts = feature_rows(words)
            sums = np.add.reduceat(self.weight[rows], np.cumsum(counts) - counts)
            return np.exp(np.clip(sums, -30, 30)), np.ones(len(words), np.int64)

        return WordTable(make, np.float64)

    def tag(self, table: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of every word, one text after the other, and the number of words in each."""
        lists = [t.split() for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        codes = table.codes([w for words in lists for w in words])
        gain = table.values[codes]
        return marginals(gain, sizes, self.move, self.prior)[0], sizes

    def evidence_of(self, p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log odds of a text's most toxic words, ``MOST`` of them, added up; a floor for a text without words.

        Words count from ``FAINT`` on, so the sum does not grow with the length of a text, and one word that looks toxic
        by chance weighs less than several that agree.
        """
        out = np.full(len(sizes), -FLOOR)
        some = np.flatnonzero(sizes)
        if len(some):
            q = np.clip(p, 1e-12, 1 - 1e-12)
            odds = np.log(q) - np.log1p(-q)
            out[some] = np.maximum.reduceat(odds, (np.cumsum(sizes) - sizes)[some]) + (MOST - 1) * FAINT
            loud = np.flatnonzero(odds > FAINT)
            owner = np.searchsorted(np.cumsum(sizes), loud, "right")
            order = np.lexsort((-odds[loud], owner))
            loud, owner = loud[order], owner[order]
            place = np.arange(len(loud)) - np.searchsorted(owner, owner)
            more = (place > 0) & (place < MOST)
            np.add.at(out, owner[more], odds[loud[more]] - FAINT)
            out[some] = np.clip(out[some], -FLOOR, FLOOR)
        return out

    def scores(self, p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence_of(p, sizes) + self.intercept, -40, 40)))


def train(texts: list[str], labels: np.ndarray, totals: dict[int, int], *, seed: int = 7) -> ToxicityModel:
    """Learns the field from a sample; every fifth row only shapes the curve from evidence to score."""
    labels = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    turn = np.arange(len(texts)) % 5
    learn = np.flatnonzero(turn != 0)
    marks = evidence([texts[i] for i in learn], labels[learn])
    index: dict[str, int] = {}
    lists = {}
    for i in learn:
        words = texts[i].split()
        lists[i] = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words))
    rows, counts = feature_rows(list(index))
    begin = np.cumsum(counts) - counts
    toxic_word = np.array([any(c in marks for c in cues(w)) for w in index], bool)
    weight, move, prior = np.zeros(BUCKETS), np.zeros((2, 2)), -3.0
    seen = np.zeros(BUCKETS)
    docs = []
    for i in learn:
        codes = lists[i]
        truth = toxic_word[codes] & bool(labels[i])
        if len(codes):
            docs.append((codes, truth, bool(labels[i]) and not truth.any()))
    owner = np.repeat(np.arange(len(index)), counts)
    for _ in range(EPOCHS if docs else 0):
        for batch in np.array_split(rng.permutation(len(docs)), -(-len(docs) // BATCH)):
            codes = np.concatenate([docs[k][0] for k in batch])
            truth = np.concatenate([docs[k][1] for k in batch]).astype(float)
            sizes = np.array([len(docs[k][0]) for k in batch])
            unmarked = np.array([docs[k][2] for k in batch])
            emit = np.exp(np.clip(np.add.reduceat(weight[rows], begin), -30, 30))
            gain = emit[codes]
            e = np.exp(move)
            p, ahead, behind = marginals(gain, sizes, e, float(np.exp(prior)))
            heads = np.cumsum(sizes) - sizes
            some = 1 - none_toxic(ahead, sizes, e)
            hidden = np.repeat(unmarked, sizes)
            truth[hidden] = (p / np.repeat(some, sizes))[hidden]
            miss = np.bincount(codes, p - truth, len(index))
            step = np.bincount(rows, miss[owner], BUCKETS)
            seen += step**2
            weight -= RATE * step / np.sqrt(seen + 1e-8) + 1e-4 * RATE * weight * (step != 0)
            inside = np.ones(len(codes), bool)
            inside[heads] = False
            t = np.flatnonzero(inside)
            if len(t):
                r, s = ahead[t - 1], gain[t] * behind[t]
                joint = np.stack([np.full(len(t), e[0, 0]), e[0, 1] * s, r * e[1, 0], r * e[1, 1] * s], 1)
                joint /= joint.sum(1, keepdims=True)
                some = np.repeat(some, sizes)[t][:, None]
                given = (joint - (1 - some) * np.array([1, 0, 0, 0])) / some  # if some word is toxic
                seen_pairs = np.eye(4)[(2 * truth[t - 1] + truth[t]).astype(int) * ~hidden[t]]
                want = np.where(hidden[t][:, None], given, seen_pairs).sum(0)
                move -= RATE * ((joint.sum(0) - want) / len(t)).reshape(2, 2)
            prior -= RATE * float((p[heads] - truth[heads]).mean())
    model = ToxicityModel(weight, np.exp(move), float(np.exp(prior)))
    aside = np.flatnonzero(turn == 0)
    if len(aside):
        p, sizes = model.tag(model.table(), [texts[i] for i in aside])
        sampled = {k: max(1, int((labels == k).sum())) for k in (0, 1)}
        weights = np.array([totals.get(int(k), 1) / sampled[int(k)] for k in labels[aside]])
        model.slope, model.intercept = labelled.platt(model.evidence_of(p, sizes), labels[aside], weights)
    return model


def score(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of every whole text with the words that offend: ``doc_id, score, spans array<struct<start, end, p>>``.

    Spans are code-point offsets (end exclusive) of words whose marginal is ``threshold`` or more. A null or empty
    text has no words, so no spans and the lowest score. Repeated rows and null ids are scored as they are; other
    columns are left out, so their names cannot clash; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    name = uuid.uuid4().hex
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = held(name, lambda: (shared.value, shared.value.table()))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                p, sizes = own.tag(table, texts[a:b])
                spans: list[list[dict]] = [[] for _ in range(b - a)]
                begin = np.cumsum(sizes) - sizes
                for i in np.unique(np.searchsorted(begin + sizes, np.flatnonzero(p >= threshold), "right")).tolist():
                    mine = p[begin[i] : begin[i] + sizes[i]]
                    spans[i] = [{"start": m.start(), "end": m.end(), "p": float(q)} for m, q in zip(re.finditer(r"\S+", texts[a + i]), mine, strict=True) if q >= threshold]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own.scores(p, sizes), pa.float64()), pa.array(spans, pa.list_(span))], names=["doc_id", "score", "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(trimmed(run), f"doc_id {kind}, score double, spans array<struct<start:int,end:int,p:double>>")


def fit(docs: DataFrame, labels: DataFrame, *, parts: int = 3, held: int = 1, per_class: int = labelled.PER_CLASS) -> ToxicityModel:
    """Trains on a sample of the rows whose fold is not held out, ``per_class`` rows of each label at most."""
    rows, totals = labelled.sample(docs, labels, "toxic", parts, held, per_class=per_class)
    return labelled.train_on_executor(rows, lambda texts, marks: train(texts, marks, totals))
