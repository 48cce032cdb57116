"""Operator 13 against a trie that is built from whole sequences of turns."""

import hashlib
import zlib

import numpy as np
import pytest

from newsloom.llm import catalog, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv int, depth string, k1 string"


def plain(rows):
    """The nodes as tuples, by the contract's words."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members = {}
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in members)]
        ends = sorted(c for c in cs if len(rebuilt[c]) == len(node))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
            sum(len(m) == len(node) + 1 and m[:-1] == node for m in members), len(leaves),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[1], r[0]))


def table(rng, convs, length, words):
    rows = []
    for c in convs:
        for t in range(int(rng.integers(1, length + 1))):
            turn = None if rng.random() < 0.1 else t
            text = rng.choice([*words, None])
            rows.append((int(c), turn, [None, "user", "bot"][t % 3 if turn is not None else 0], None if text is None else str(text), 1, "x", "y"))
    return [*rows, (None, 1, "user", "of no conversation", 1, "", "")]


@pytest.mark.parametrize(("convs", "length", "words"), [(range(60, 260), 7, ["", "a", "bcé"]), (range(300), 3, ["same"]), ([5, 7, 100, 101], 40, ["u", "v"])])
def test_trie(spark, convs, length, words, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)  # paths cross segments, ids cross runs
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    rows = table(np.random.default_rng(length), convs, length, words)
    got = prefix_trie.shared_prefixes(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert order([tuple(r) for r in got.collect()]) == order(plain(rows))


def test_repeated_rows_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 64)
    rows = [(200, 1, "user", "again", 1, "", "")] * 50 + [(3, t, "user", "x" * (t % 3), 1, "", "") for t in range(400)] + [(4, t, "user", "x" * (t % 3), 1, "", "") for t in range(399)]
    got = prefix_trie.shared_prefixes(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert order([tuple(r) for r in got]) == order(plain(rows))


def test_empty(spark):
    assert prefix_trie.shared_prefixes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.shared_prefixes(spark.createDataFrame([(None, 1, "a", "b", 1, "", "")], SCHEMA)).collect() == []


def test_conversations_without_turns(spark):
    rows = [(c, 0, "user", "only", 1, "", "") for c in range(1, 30)]  # their base conversation is not there
    got = prefix_trie.shared_prefixes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert order([tuple(r) for r in got]) == order(plain(rows)) and {r["depth"] for r in got} == {0, 1}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert order([tuple(r) for r in catalog.queries()["op13_prefix_trie"](spark, sf).collect()]) == order(plain(rows))
