"""Clashing names, ids of any type, nulls, repeated rows and empty tables; scores and matches against plain loops."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm import ann, decontaminate, jaccard, line_dedup, quality, storage, toxicity
from newsloom.llm.catalog import URL_RULES
from newsloom.llm.url_filter import filter_urls

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 1, 2, 3, 4), (2, "a b c d e f g", 5, 6, 7, 8), (None, None, 9, 9, 9, 9)], "doc_id long, text string, repeats int, _gone int, row_key int, lines_gone int")
    assert sorted(r["doc_id"] or 0 for r in jaccard.keep_first(docs).collect()) == [0, 1]
    cleaned = line_dedup.remove(docs, line_dedup.repeated_lines(docs, short=True)).orderBy("repeats").collect()
    assert [(r["repeats"], r["_gone"], r["text"]) for r in cleaned] == [(1, 2, "a b c d e f g"), (5, 6, ""), (9, 9, None)]
    items = spark.createDataFrame([(7, "b c d")], "item_id int, text string")
    kept = decontaminate.remove(docs, items)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [None]


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(10,0)"])
def test_ids_of_any_type(spark, kind):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([("3", text), ("10", text), ("20", text + " eight"), ("4", "other"), (None, text)], "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = {str(r["doc_id"]): str(r["component_id"]) for r in jaccard.similar_groups(docs).collect()}
    first = "10" if kind == "string" else "3"  # ids in their own order
    assert got == {"3": first, "10": first, "20": first, "4": "4", "None": "None"}
    items = spark.createDataFrame([("9", text)], "item_id string, text string").withColumn("item_id", F.col("item_id").cast(kind))
    assert sorted(str(r["doc_id"]) for r in decontaminate.matches(docs, items).collect()) == ["10", "20", "3", "None"]


def test_a_document_of_several_texts_keeps_its_links(spark):
    a, b = "a b c d e f g h i j k l m n o p q r s t", "z y x w v u t s r q p o n m l k j i h g"
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (6, b + " f"), (7, b), (8, "alone")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.similar_groups(docs).collect()}
    assert got == {(1, 1), (5, 1), (6, 1), (7, 1), (8, 8)}


def test_entries_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ENTRY_SIDE", 2)
    monkeypatch.setattr(line_dedup, "ENTRY_SIDE", 2)
    rng = random.Random(5)
    common = [f"c{i}" for i in range(40)]
    docs = [(i, " ".join(common[k % 5 * 8 : k % 5 * 8 + 8] + [f"x{k % 9}_{j}" for j in range(12)])) for i, k in enumerate(rng.choices(range(45), k=60))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in docs}
    root = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(frame).collect()} == root


def test_a_short_item_leaves_the_others_alone():
    rng = random.Random(2)
    hasher = decontaminate.word_hasher()
    items = [" ".join(f"w{rng.randrange(999)}" for _ in range(40)) for _ in range(20)]
    flat = [decontaminate.sequences(hasher, [t])[0].tolist() for t in [*items, "lone"]]
    assert {decontaminate.shape(len(w)) for w in flat} == {(decontaminate.ANCHOR, decontaminate.STEPS, decontaminate.SAMPLED), (1, 1, 1)}


def test_short_items_and_recall(spark):
    """Every place of every document against every item by plain edit distance."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([1, 3, 6, 7, 9, 12, 14, 20, 33])] + [(50, "v1 v2 v3 v4 v5 v6 v7 v8 v9 v10 v11 v12"), (51, None), (52, "!!")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(40)]
    for i in range(40, 100):
        own = rng.choice(items[:10])[1].split()
        for _ in range(int(0.15 * len(own))):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        words = rng.choices(vocabulary, k=30)
        at = rng.randrange(31)
        docs.append((i, " ".join(words[:at] + own + words[at:])))

    truth = {(d, k): e for d, t in docs for k, i in items if i and re.findall(r"\w+", i) and (e := least_edits(re.findall(r"\w+", i), t.split())) <= int(0.15 * len(re.findall(r"\w+", i)))}
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert all(truth.get(key) == edits for key, edits in got.items())
    assert len(got) >= 0.98 * len(truth) and len(truth) > 60


def least_edits(item, words):
    """Edits between an item and the part of a text that is nearest to it, row by row."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i] + [0] * len(words)
        for j, y in enumerate(words, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return min(row)


def test_items_that_walks_miss_are_met_by_segments(monkeypatch):
    """Every item and every text, with no link lost: as the walks do not reach such a recall, segments take over."""
    monkeypatch.setattr(decontaminate, "MOST_WALKS", 3)
    rng = np.random.default_rng(1)
    items = [rng.integers(0, 60, int(n)).tolist() for n in rng.integers(1, 40, 60)]
    texts = []
    for k in range(400):
        own = list(items[k % len(items)])
        for _ in range(int(0.15 * len(own)) + k % 2):
            at = int(rng.integers(len(own))) if own else 0
            own[at : at + int(rng.integers(2))] = rng.integers(0, 60, int(rng.integers(2))).tolist()
        texts.append([*rng.integers(0, 60, int(rng.integers(30))).tolist(), *own, *rng.integers(0, 60, int(rng.integers(30))).tolist()])
    block = decontaminate.Benchmark(list(range(len(items))), items)
    assert block.calibrate(1.1) == 1.0 and block.lengths
    got = {(t, k): edits for t, k, _, _, edits in block.search(np.array([w for t in texts for w in t], np.uint64), np.array(list(map(len, texts))))}
    want = {(t, k): e for t, text in enumerate(texts) for k, item in enumerate(items) if (e := least_edits(item, text)) <= int(0.15 * len(item))}
    assert got == want and len(want) > 300


def test_the_best_place_of_an_item_counts():
    """A text that holds an item with edits first and without behind it, so near that the windows of both overlap."""
    rng = np.random.default_rng(4)
    item = rng.integers(0, 1 << 60, 40).tolist()
    worse = [*item[:10], 1, 2, 3, *item[13:]]
    block = decontaminate.Benchmark([0], [item])
    block.calibrate(0.99)
    for text, place in (([*worse, *item], 40), ([*item, *worse], 0), ([*worse[20:], *item, *worse], 20)):
        assert block.search(np.array(text, np.uint64), np.array([len(text)])) == [(0, 0, place, 40, 0)]


def plain_quality(model, text):
    """A text's score by loops over its features."""
    spread = lambda h: int(quality.mix(np.array([h % (1 << 64)], np.uint64))[0])
    words, gains = text.split(), []
    for i, w in enumerate(words):
        own = xxhash.xxh64_intdigest(w)
        gains.append(model.gain[spread(own) % quality.BUCKETS])
        marked = "<" + w + ">"
        for n in quality.GRAMS:
            for k in range(len(marked) - n + 1):
                h = n
                for c in marked[k : k + n]:
                    h = (h * 1_000_003 + ord(c)) % (1 << 64)
                gains.append(model.gain[spread(h) % quality.BUCKETS])
        if i:
            gains.append(model.gain[spread(xxhash.xxh64_intdigest(words[i - 1]) * 3 + own) % quality.BUCKETS])
        before = [j for j in range(i) if words[j] == w]
        lag = (i - before[-1]).bit_length() if before else 0
        gains.append(model.gain[spread(lag + 0x5EED0000) % quality.BUCKETS])
    z = model.slope * (np.sum(gains, dtype=float) / max(1, len(gains)) + model.bias) + model.intercept
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def test_quality_scores_match_plain_loops(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["ab", "cde", "für", "wörter", "x", "spam", "again"], k=rng.randint(1, 40))) for _ in range(200)]
    labels = np.array([int("spam" not in t) for t in texts])
    model = quality.train(texts, labels, {0: 90, 1: 110})
    cases = [*texts[:40], "", " ", "one", "one one one", "日本 語 語"]
    got = [r["score"] for r in quality.score(spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert got == pytest.approx([plain_quality(model, t) for t in cases], abs=1e-5)


def test_toxicity_scores_match_plain_loops(spark):
    rng = np.random.default_rng(3)
    model = toxicity.ToxicityModel(rng.normal(size=toxicity.BUCKETS) / 4, np.exp(rng.normal(size=(2, 2))), 0.2, 0.8, -0.1)
    cases = ["a", "some Words, here", "x " * 70 + "y", "", "é ü ü"]
    got = [r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    want = []
    for t in cases:
        gains = []
        for w in t.split():
            rows, _ = toxicity.feature_rows([w])
            gains.append(np.exp(np.clip(model.weight[rows].sum(), -30, 30)))
        every, ahead = [], []
        for g in gains:
            ahead.append(np.array([1, model.prior * g]) if not ahead else (ahead[-1] @ model.move) * np.array([1, g]))
            ahead[-1] = ahead[-1] / ahead[-1].sum()
        behind = np.ones(2)
        for g, a in zip(gains[::-1], ahead[::-1], strict=True):
            odds = a * behind
            every.append(float(np.log(odds[1] / odds[0])))
            behind = model.move @ (np.array([1, g]) * behind)
            behind = behind / behind.sum()
        top, *rest = sorted(every, reverse=True) or [-np.inf]
        whole = top + sum(max(r, toxicity.FAINT) for r in [*rest, *[-np.inf] * toxicity.MOST][: toxicity.MOST - 1])
        best = float(np.clip(whole, -toxicity.FLOOR, toxicity.FLOOR))
        want.append(1 / (1 + np.exp(-(model.slope * best + model.intercept))))
    assert got == pytest.approx(want, abs=1e-6)


def test_none_toxic_is_exact():
    rng = np.random.default_rng(0)
    sizes, move, prior = np.array([1, 3, 5]), np.exp(rng.normal(size=(2, 2))), 0.4
    gain = np.exp(rng.normal(size=9))
    ahead = toxicity.marginals(gain, sizes, move, prior)[1]
    got, at = toxicity.none_toxic(ahead, sizes, move), 0
    for n, p in zip(sizes, got, strict=True):
        total = 0.0
        for path in range(1 << n):
            states = [path >> k & 1 for k in range(n)]
            weight = prior ** states[0] * np.prod([gain[at + k] ** s for k, s in enumerate(states)]) * np.prod([move[a, b] for a, b in zip(states, states[1:])])
            total += weight
        assert p == pytest.approx(move[0, 0] ** (n - 1) / total)
        at += n


def test_links_of_any_form(spark):
    page = '<link rel=canonical href="{}"><link rel="canonical" href="mailto:x@y.de"><meta http-equiv="refresh" content="0; url={}">'
    rows = [(1, "http://h.net/a/b.html", page.format("c.html", "../de/x")), (2, "http://h.net/a/c.html", page.format("?q=1", "#top")), (3, "http://h.net/de/x", ""), (4, "http://h.net/a/c.html?q=1", None), (5, None, page.format("/x", "/y"))]
    rows.append((6, "http://other.com/de/1", page.format("http://h.net/de/x", "")))
    got = {r["page_id"]: (r["component"], r["verdict"]) for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    assert {got[k][0] for k in (1, 2, 3, 4, 6)} == {"h.net/a/b.html"} and got[5] == (None, "allow")
    assert all(got[k][1] == "block" for k in (1, 2, 3, 4, 6))


def test_stages_take_empty_and_odd_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "one line of some length that stays\nshort", "en", "s", 40), (2, None, None, None, None), (2, "", "en", "s", 0), (None, "one line of some length that stays", "en", "s", 34), (3, "one line of some length that stays\nshort", "en", "s", 40)]
    for data, kept in ((rows, 4), ([], 0)):
        docs = spark.createDataFrame(data, DOC)
        docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        now = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = storage.written(stage(spark, now, str(tmp_path)), name)
            assert now.columns == docs.columns
        out = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
        assert out.count() >= kept and out.count() <= len(data)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        storage.shared_dir(Session())


def test_bins_hold_every_leaf():
    bins, parts = ann.packed([5, 5, 25, 0, 4, 9], 10)
    assert bins == [0, 0, 1, 2, 2, 3] and parts == [1, 3, 1, 1]
    assert ann.packed([], 10) == ([], [])
