"""Operator 11 against a search through all entries in plain loops."""

import hashlib
import math

import numpy as np
import pytest

from newsloom.llm import catalog, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, v string, carry int"


def plain(rows, parts=16, entries=64, rounds=2):
    """Rows of (vec_id, code, error, label_error) and the digest, by the contract's words."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(z) // len(mine[e]) for z in zip(*mine[e], strict=True)] if e in mine else y for e, y in enumerate(books[p])]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by[label] = by.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), s, by[label]) for (i, _, label), f, s in zip(kept, found, errors, strict=True)], digest


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def table(rng, n, steps):
    rows = [(int(i), [float(x) for x in rng.integers(-steps, steps + 1, 32) / 256 + rng.choice([0, 1e-4], 32)], int(i) % 3 or None, "x", 1) for i in range(n)]
    return [*rows, rows[3], (None, rows[5][1], None, "y", 2), (n + 1, None, 1, None, None), (n + 2, [None] * 32, 1, None, None), (n + 3, [float("nan")] * 32, 1, None, None), (n + 4, [float("inf")] * 32, 2, None, None)]


@pytest.mark.parametrize(("n", "steps"), [(300, 40), (150, 2), (20, 3)])  # spread, full of ties, fewer rows than entries
def test_compress(spark, n, steps):
    rows = table(np.random.default_rng(n), n, steps)
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want, digest = plain(rows)
    assert order([tuple(r)[:4] for r in got]) == order(want) and {r["codebooks_sha256"] for r in got} == {digest}


def test_odd_tables(spark):
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, "", 1), (2, [], 1, "", 1)], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(1, [0.5] * 20, 1, "", 1)], SCHEMA))
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 16, 1, "", 1)], SCHEMA)).collect()


def test_tree_finds_what_a_full_search_finds():
    rng = np.random.default_rng(0)
    for size, spread in ((1, 5), (64, 3), (64, 1000), (256, 1 << 26)):
        entries, points = rng.integers(-spread, spread + 1, (size, 4)), rng.integers(-spread, spread + 1, (500, 4))
        index, apart = vector_codes.nearest(points, entries, vector_codes.grow(entries, np.arange(size)))
        every = ((points[:, None, :] - entries[None]) ** 2).sum(2)
        assert (index == every.argmin(1)).all() and (apart == every.min(1)).all()


def test_decoded_vectors(spark):
    rows = table(np.random.default_rng(1), 70, 30)
    kept = vector_codes.prepared(spark.createDataFrame(rows, SCHEMA))
    books = vector_codes.train(kept)
    whole = {r["id"]: r for r in vector_codes.decode(vector_codes.encode(kept, books), books).collect()}
    for r in kept.collect():
        got = whole[r["id"]]
        want = [x / 256 for p, c in enumerate(got["codes"]) for x in books[p][c].tolist()]
        assert got["decoded"] == want and got["error"] == sum((a - 256 * b) ** 2 for a, b in zip(r["v"], want, strict=True))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog.queries()["op11_vector_codes"](spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    source = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, digest = plain(source)
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(want) and got.first()["codebooks_sha256"] == digest
