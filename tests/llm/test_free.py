"""The other operators against brute force, exact round trips and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import ann, decontaminate, jaccard, quality, sentencepiece_bpe, token_files, toxicity
from newsloom.llm.catalog import tokenizer
from newsloom.llm.words import chunks

ODD = ["", " ", "  a  b ", "a\nb", "\n\n ", "a▁b", "日本\x00x", "<s>a</s>", "a\tb　c", " \n", "def  f():\n    return 1", "aaaa" * 50, "////" * 9 + " ..//..", "🎉🎊 x", "a" * 3000, " " * 90]


@pytest.fixture(scope="module")
def model():
    return sentencepiece_bpe.PieceModel(tokenizer("piece_bpe_32k.model"))


def test_sentencepiece_is_exact(model):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for alphabet in ("abcdethingres/. .-—日ß▁\n  🎉 ", "enctesxt r/") for _ in range(2000)]
    table = sentencepiece_bpe.WordTable(model.key_ids, np.int32, limit=500)
    for a, b in chunks(texts, 3000):
        ids, counts = sentencepiece_bpe.encode_texts(model, table, texts[a:b])
        ends = np.r_[0, np.cumsum(counts)]
        decoded = model.decode(ids, ends)
        for i, t in enumerate(texts[a:b]):
            own = ids[ends[i] : ends[i + 1]].tolist()
            assert own == library.encode(t) and decoded[i] == library.decode(own), t


def test_sentencepiece_decodes_any_ids(model):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    rng = random.Random(2)
    for ids in [[rng.randrange(3, 32_000) for _ in range(8)] for _ in range(200)] + [[3 + 0xE2, 3 + 0x82, 300], [3 + 0xFF]]:
        assert model.decode(np.array(ids), np.array([0, len(ids)])) == [library.decode(ids)], ids


def test_sentencepiece_frame(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    rows = sentencepiece_bpe.digests(sentencepiece_bpe.encode_decode(frame, tokenizer("piece_bpe_32k.model"))).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 2, 2]
    assert sentencepiece_bpe.encode_decode(frame.limit(0), tokenizer("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 40_000])
def test_coder_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 5000
    coder = token_files.Coder.of(np.bincount(ids, minlength=1))
    block = coder.encode(ids, every=8)
    assert (coder.decode(block) == ids).all()
    marks = token_files.HEADER.unpack_from(block)[4]
    parts = [coder.decode(block, k, k + 1) for k in range(marks)]
    assert not n or (np.concatenate(parts) == ids).all()
    if n:
        broken = bytearray(block)
        broken[-1] ^= 1
        with pytest.raises(token_files.CorruptBlock):
            coder.decode(bytes(broken))


def test_token_files(spark, monkeypatch):
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    rng = random.Random(2)
    texts = ["", None, "<|endoftext|>hi x", "áb À ́x", "Σας ΣΑΣ's 'll don't 12 3４", "a\x1c!\x1d!", "!!\x85!! a b　c\tq\r\nz", " x  !"]
    texts += ["".join(rng.choice("abC't re!?.12 \n\t́é \x1cΣ<|endoftext|>") for _ in range(50)) for _ in range(500)]
    frame = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3).withColumn("ids", F.lit(0))
    monkeypatch.setattr(token_files, "BLOCK_IDS", 1500)
    monkeypatch.setattr(token_files, "PART_IDS", 4000)
    folder = token_files.encode_to_files(frame, tokenizer("word_bpe_49k.json"), end_id=2)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(token_files.read_tokens(spark, folder)).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[i * 3] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        at += len(ids)
    empty = token_files.encode_to_files(frame.limit(0), tokenizer("word_bpe_49k.json"), end_id=2)
    assert token_files.read_tokens(spark, empty).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("frequent", [64, 3])
def test_jaccard_matches_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] for _ in range(25)]
    docs = []
    for i in range(200):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((i, " ".join(words) if i % 9 else "\t".join(words).upper()))
    docs += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One TWO"), (905, "one two three")]
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("doc", F.lit("clash")).withColumn("n", F.lit(0))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(frame).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}
    if frequent == 64:
        kept = {r["doc_id"] for r in jaccard.keep_first(frame).collect()}
        assert kept == {d for d in sets if find(d) == d}


def test_jaccard_edges(spark):
    frame = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x " * 30_000)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.similar_groups(frame).collect())
    assert got == [("1", 2, "1"), ("1", 2, "1"), ("2", 1, "2"), ("None", 2, "None")]
    assert jaccard.similar_groups(frame.limit(0)).count() == 0


def test_neighbours_recall(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    points[500:1500] = points[500]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(5001, None), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [1.0] * 3), (None, points[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("clash"))
    got: dict = {}
    for r in ann.neighbours(frame, F.col("vec_id") % 100 == 0, sample=1500).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 3000, 100):
        gaps = np.sqrt(((points - points[q]) ** 2).sum(1))
        gaps[q] = np.inf
        best = np.lexsort((np.arange(3000), gaps))[:10]
        own = [v for _, v, _ in sorted(got[q])]
        hits += len(set(own) & set(best.tolist()))
        assert [s for *_, s in sorted(got[q])] == pytest.approx([gaps[v] for v in own])
    assert set(got) == set(range(0, 3000, 100)) and hits >= 0.9 * 300
    few = ann.neighbours(frame.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2, 3]
    assert ann.neighbours(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_decontamination(spark):
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(3000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(14, 60)))) for k in range(40)] + [(99, None), (98, "...")]
    docs, truth = [], set()
    for i in range(240):
        words = [rng.choice(vocabulary) for _ in range(150)]
        if i % 2:
            k = rng.randrange(40)
            own = items[k][1].split()
            for _ in range(rng.randint(0, int(0.15 * len(own)))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            at = rng.randrange(150)
            words[at:at] = [w.upper() + "!!" for w in own] if i % 3 else own
            truth.add((i, k))
        docs.append((i, " ".join(words)))
    docs += [(1000, None), (1001, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(frame, benchmark).collect()}
    assert found <= truth and len(found) >= 0.97 * len(truth)
    kept = {r["doc_id"] for r in decontaminate.remove(frame, benchmark).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found}
    assert decontaminate.matches(frame.limit(0), benchmark).count() == decontaminate.matches(frame, benchmark.limit(0)).count() == 0


def corpus(bad, n=260):
    rng = random.Random(9)
    syllables = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "vi"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 80))]
        labels.append(int(i % 2))
        texts.append(" ".join(bad(words, rng) if i % 2 else words))
    return texts, np.array(labels)


def test_quality_held_out():
    texts, junk = corpus(lambda w, rng: [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [w[0]] * len(w))
    model = quality.train(texts[:200], 1 - junk[:200], {0: 100, 1: 100})
    scores = model.scores(model.table(), texts[200:] + [""])
    assert ((scores[:-1] >= 0.7) == (junk[200:] == 0)).mean() >= 0.95 and 0 <= scores[-1] <= 1


def test_toxicity_held_out(spark):
    def insert(words, rng):
        for _ in range(2):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["grumbo", "Blorth.", "xeno" + rng.choice(["ta", "ri", "mo"])]))
        return words

    texts, toxic = corpus(insert)
    model = toxicity.train(texts[:200], toxic[:200], {0: 100, 1: 100})
    p, sizes = model.tag(model.table(), texts[200:])
    assert ((model.scores(p, sizes) >= 0.7) == (toxic[200:] == 1)).mean() >= 0.95
    frame = spark.createDataFrame([(1, "ta ri Blorth. mo"), (2, None), (2, "")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    rows = toxicity.score(frame, model).collect()
    assert [(s["start"], s["end"]) for r in rows if r["doc_id"] == 1 for s in r["spans"]] == [(6, 13)]
    assert all(r["score"] < 0.7 for r in rows if r["doc_id"] == 2)


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 2, 0, 130, 7])
    gain, move, prior = np.exp(rng.normal(size=140)), np.exp(rng.normal(size=(2, 2))), 0.3
    got, at = toxicity.marginals(gain, sizes, move, prior)[0], 0
    for n in sizes:
        own = gain[at : at + n]
        forward = [np.array([1, prior * own[0]])] if n else []
        for g in own[1:]:
            forward.append((forward[-1] / forward[-1].sum() @ move) * np.array([1, g]))
        backward = [np.ones(2)]
        for g in own[:0:-1]:
            b = move @ (np.array([1, g]) * backward[-1])
            backward.append(b / b.sum())
        for k in range(n):
            joint = forward[k] * backward[n - 1 - k]
            assert got[at + k] == pytest.approx(joint[1] / joint.sum())
        at += n
