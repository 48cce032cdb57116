"""Operator 12 against dictionaries of counts and an EM that takes one token after the other."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from newsloom.llm import catalog, lm_scoring

SCHEMA = "doc_id long, text string, score string, n1 int, held boolean"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]  # None: the end


def grams(tokens, n):
    padded = ["<start>"] * (n - 1) + tokens
    return [tuple(padded[i : i + n]) for i in range(len(tokens))]


def plain(rows, order, parts=7, held=2):
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) and the weights of every order."""
    docs = [(i, words_of(t), i is not None and zlib.crc32(str(i).encode()) % parts == held) for i, t, *_ in rows]
    train = [t for _, t, out in docs if not out]
    counts = [Counter(g for t in train for g in grams(t, n)) for n in range(1, order + 1)]
    tokens, documents, words = sum(map(len, train)), len(train), len(counts[0])

    def contexts(own, n, less_tokens, less_docs, minus):
        """Count of the context of every token of a document in an order."""
        if n == 1:
            return [tokens - less_tokens] * len(own)
        before = grams(own, n - 1)
        return [documents - less_docs if i == 0 else counts[n - 2][before[i - 1]] - minus[n - 2][before[i - 1]] for i in range(len(own))]

    def probabilities(own, upto, weights, deleted):
        minus = [Counter(grams(own, n)) if deleted else Counter() for n in range(1, order + 1)]
        out = [1 / (words + 1)] * len(own)
        for n in range(1, upto + 1):
            seen = contexts(own, n, len(own) * deleted, int(deleted), minus)
            out = [w * (counts[n - 1][g] - minus[n - 1][g]) / c + (1 - w) * p if c > 0 else p for g, c, p, w in zip(grams(own, n), seen, out, [weights[n - 1][int(math.log2(c))] if c > 0 else 0 for c in seen], strict=True)]
        return out

    weights = []
    for n in range(1, order + 1):
        cells = []
        for own in train:
            minus = [Counter(grams(own, k)) for k in range(1, order + 1)]
            below = probabilities(own, n - 1, weights, True)
            for g, c, p in zip(grams(own, n), contexts(own, n, len(own), 1, minus), below, strict=True):
                if c > 0:
                    cells.append((int(math.log2(c)), (counts[n - 1][g] - minus[n - 1][g]) / c / p))
        made = [None] * 64
        for b in {b for b, _ in cells}:
            ratios, w = np.array([r for x, r in cells if x == b]), 0.5
            for _ in range(3000):
                w = ((w * ratios / (w * ratios + 1 - w)).sum() + 0.5) / (len(ratios) + 1)
            made[b] = w
        known = [b for b in range(64) if made[b] is not None]
        weights.append([made[max([k for k in known if k <= b], default=known[0])] if known else 0.5 for b in range(64)])
    out = []
    for i, own, is_out in docs:
        base = sum(math.log10((counts[0][(t,)] + 1) / (tokens + 1 * (words + 1))) for t in own)
        out.append((i, is_out, len(own), sum(counts[0][(t,)] > 0 for t in own), tokens, base, sum(math.log10(p) for p in probabilities(own, order, weights, False))))
    return out, weights


def table(seed, n):
    rng = np.random.default_rng(seed)
    some = ["the", "The", "of", "and", "é", "x y", "Z", "|"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 60))
        text = "".join(rng.choice(some[: int(rng.integers(2, 48))]) + rng.choice([" ", "\n", " \t", "\x0b"]) for _ in range(size))
        rows.append((i, text, "s", 1, True))
    return [*rows, rows[2], (None, "the of the", None, None, None), (n + 1, None, "", 0, False), (n + 2, "", "", 0, False), (n + 3, " \n ", "", 0, False), (n + 4, "the of " * 4000, "", 0, False)]


def close(got, want):
    got, want = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[6])) for x in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=2e-3)  # ratios are counted in steps of 1.1 %


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, order, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_CHARS", 700)  # several chunks
    monkeypatch.setattr(lm_scoring, "ASKED", 200)  # and buckets
    rows = table(order, 80)
    got = lm_scoring.score(spark.createDataFrame(rows, SCHEMA).repartition(3), order=order)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    close([tuple(r) for r in got.collect()], plain(rows, order)[0])


def test_weights_are_most_likely():
    rng = np.random.default_rng(0)
    ratio = np.exp2(rng.integers(-4, 8, 300).astype(float))
    n = rng.integers(1, 50, 300).astype(float)
    weight = lm_scoring.maximised(np.full(300, 5), ratio, n)
    assert (weight == weight[5]).all()  # every other bucket takes the only one's
    grid = np.linspace(1e-4, 1 - 1e-4, 20001)
    likely = [(n * np.log(w * ratio + 1 - w)).sum() + 0.5 * math.log(w) + 0.5 * math.log(1 - w) for w in grid]
    assert abs(grid[int(np.argmax(likely))] - weight[5]) < 1e-3


def test_numbers_keep_their_value():
    for top in (0, 255, 256, 1 << 31, (1 << 64) - 1):
        numbers = np.array([0, top, top // 2], np.uint64)
        assert (lm_scoring.unpacked(lm_scoring.packed(numbers)) == numbers).all()
    assert len(lm_scoring.unpacked(lm_scoring.packed(np.zeros(0, np.uint64)))) == 0


def test_odd_tables(spark):
    assert lm_scoring.score(spark.createDataFrame([], SCHEMA)).collect() == []
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, "nothing to learn from", "", 1, True) for i in held]
    assert {tuple(r)[1:] for r in lm_scoring.score(spark.createDataFrame(rows, SCHEMA)).collect()} == {(True, 5, 0, 0, 0.0, 0.0)}
    one = [(next(i for i in range(60) if i not in held), "a b a b", "", 1, True)]
    close([tuple(r) for r in lm_scoring.score(spark.createDataFrame(one, SCHEMA)).collect()], plain(one, lm_scoring.ORDER)[0])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in catalog.queries()["op12_lm_scoring"](spark, sf).collect()]
    close(got, plain(rows, lm_scoring.ORDER)[0])
    out = [r for r in got if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)  # the mixture tells more than smoothed single words
