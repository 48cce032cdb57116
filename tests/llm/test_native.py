"""Line dedup, personal data and url filters against brute force."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import catalog, line_dedup, pii
from newsloom.llm.catalog import URL_RULES
from newsloom.llm.components import connected_components
from newsloom.llm.url_filter import filter_urls


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_repeats_match_brute_force(spark):
    rng = random.Random(5)
    letters = "abcdé "
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(8, 16))) for _ in range(20)]

    def changed(s):
        s = list(s)
        for _ in range(rng.randint(0, 4)):
            kind, at = rng.random(), rng.randrange(len(s) + 1)
            if kind < 0.33:
                s.insert(at, rng.choice(letters))
            elif s:
                s[min(at, len(s) - 1) : min(at, len(s) - 1) + 1] = [] if kind < 0.66 else [rng.choice(letters)]
        return "".join(s)

    docs = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(1, 6)))) for i in range(80)] + [(500, None), (501, ""), (502, "\n\n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit("clash")).withColumn("h1", F.lit(1))
    repeats = line_dedup.repeated_lines(frame, min_chars=6)
    got = {r["doc_id"]: list(r["repeats"]) for r in repeats.collect()}
    lines = sorted((d, n, line) for d, t in docs for n, line in enumerate((t or "").split("\n")))
    expected = {d: [] for d, _ in docs}
    for i, (d, n, line) in enumerate(lines):
        if len(line) >= 6 and any(len(m) >= 6 and distance(line, m) <= 2 for _, _, m in lines[:i]):
            expected[d].append(n)
    assert got == expected
    kept = {r["doc_id"]: r["text"] for r in line_dedup.remove(frame, repeats).collect()}
    assert kept == {d: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in expected[d]) for d, t in docs}


def test_line_repeats_of_repeated_rows_and_nulls(spark):
    line = "the same line, long enough to count here"
    rows = [(1, line), (1, line), (2, line), (None, line), (3, "short\nshort")]
    got = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), list(r["repeats"])) for r in got) == [("1", [0]), ("1", [0]), ("2", [0]), ("3", []), ("None", [])]
    assert line_dedup.repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_repeat_exactly(spark, tmp_path):
    rows = [(1, "All rights reserved.\n\n \u3000"), (2, "All rights reserved.\n\n \u3000\nAll rights reserve"), (3, "x\nx\nAll rights reserved.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_lines"], r["repeats"]) for r in catalog.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (3, ""), 2: (4, "0"), 3: (3, "1,2")}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and luhn % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def spans(text):
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text or "") if valid(k, m[0])]
    return ",".join(x[2] for x in sorted(found))


def test_pii_matches_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "a@b.c_d@e.f", "x 4111 1111 1111 1111 y +1 (555) 123-4567.", "1.2.3.4.5.6.7.8 0000001.02.3.255 256.1.1.1", "é🎉 a.b+c%d@x-y.co.uk, 4111111111111111\n+49 30 1234567", "0" * 20_000, "a" * 3000 + "@b.c"]
    texts += ["".join(rng.choice("0123456789 .-+@ab()\né🎉") for _ in range(120)) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("h", F.lit(0)).withColumn("base", F.lit(0))
    for r in pii.digests(pii.find(frame)).collect():
        assert r["base_sha256"] == hashlib.sha256(spans(texts[r["doc_id"]]).encode()).hexdigest(), texts[r["doc_id"]]


def test_pii_terms_that_disclose(spark):
    secret = [(i, f"agent zanzibar wrote to me{i} at j@x.org today") for i in range(4)]
    other = [(100 + i, f"plain words today {'zq' * (i % 7)} wrote line number {i}") for i in range(300)]
    frame = spark.createDataFrame([*secret, *other, (999, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(frame).withColumn("text", F.lit("")).collect()}
    marked = {secret[i][1][s["start"] : s["end"]] for i in range(4) for s in found[i]["term_spans"]}
    assert "zanzibar" in marked and "today" not in marked and "wrote" not in marked
    assert all(not found[d]["term_spans"] for d, _ in other)
    assert pii.find(frame.limit(0)).count() == 0
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(frame.withColumn("h", F.lit(0))).collect()}
    assert clean[0] == "  wrote  0  [email] today"
    assert "zanzibar" not in clean[0] and "j@x.org" not in clean[0] and clean[999] is None and clean[100] == other[0][1]
    shas = {r["doc_id"]: r["sanitised_sha256"] for r in pii.digests(pii.find(frame)).collect()}
    assert all(shas[d] == hashlib.sha256((t or "").encode()).hexdigest() for d, t in clean.items())


def disclosed(texts, allowed=pii.ALLOWED, prior=pii.PRIOR, keep=pii.GENERAL):
    """Plain loops: what gives an entity away, with the class that may stand for it."""
    email = re.compile(PATTERNS["email"])
    lines = {x for t in texts for x in (t or "").split("\n") if x}

    def words(line):
        ws = set(re.findall(r"[^\W\d_]+", line.lower()))
        return ws | {w[:keep] + "*" for w in ws if len(w) > keep}

    held = {x: ({m[0].lower() for m in email.finditer(x)}, words(x)) for x in lines}
    n, out = len(lines), {}

    def leaks(e, t):
        n_e = sum(e in es for es, _ in held.values())
        n_t = sum(t in ws for _, ws in held.values())
        both = sum(e in es and t in ws for es, ws in held.values())
        whole = math.log(n / n_e)
        return whole > 0 and math.log(n * (both + n_e * prior / n) / ((n_t + prior) * n_e)) >= allowed * whole

    for e in {e for es, _ in held.values() for e in es}:
        for t in {t for es, ws in held.values() if e in es for t in ws if not t.endswith("*")}:
            if leaks(e, t):
                c = t[:keep] + "*"
                seen = any(e in es and c in ws for es, ws in held.values())
                out["email:" + e, t] = c if seen and not leaks(e, c) else None
    return out


def test_pii_terms_match_brute_force(spark):
    rng = random.Random(11)
    vocab = ["alpha", "alpine", "alps", "beta", "be", "c", "王伟", "münchen", "zanzibar", "zander", "quill", "the", "of", "to"]
    people = ["a@x.org", "b@x.org", "c@y.net"]
    texts = ["\n".join(" ".join(rng.choices(vocab[: rng.choice([4, 14])], k=5) + rng.choices([*people, "", "", "", "", ""], k=1)) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    texts += [texts[3]] * 5 + ["李明 b7 d@z.org", "", None, "quillfeather e@w.org", *(f"quiet quick {i}" for i in range(40))]
    docs = spark.createDataFrame([(t or "",) for t in texts], "text string")
    got = {(r["entity"], r["term"]): r["general"] for r in pii.disclosing_terms(docs).collect()}
    assert got == disclosed(texts) and ("email:d@z.org", "李明") in got and got["email:e@w.org", "quillfeather"] == "qui*"


def test_pii_terms_of_entities_seen_once_or_twice(spark):
    once = [(0, "courier quillfeather wrote today to k@y.org"), (1, "quillfeather came back")]
    twice = [(10 + i, f"agent zanzibar wrote line {'ab'[i]} to j@x.org today") for i in range(2)]
    other = [(100 + i, f"plain words today courier agent wrote line number {i} to a b k y j x org") for i in range(300)]
    texts = dict([*once, *twice, *other])
    found = {r["doc_id"]: r["term_spans"] for r in pii.find(spark.createDataFrame([*once, *twice, *other], "doc_id long, text string")).collect()}
    marked = {d: {texts[d][s["start"] : s["end"]] for s in spans} for d, spans in found.items() if spans}
    assert marked == {0: {"quillfeather"}, 10: {"zanzibar"}, 11: {"zanzibar"}}


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        (None, ("", "", None, "allow")), ("no scheme", ("", "", None, "allow")), ("http://A.Example.ORG/es/1?x", ("a.example.org", "/es/1", "example.org/es/", "block")),
        ("x://example.org", ("example.org", "", None, "allow")), ("x://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")), ("x://example.org/a", ("example.org", "/a", "org/", "allow")),
        ("https://b.com/de/x#y", ("b.com", "/de/x", "com/de/", "block")), ("https://xcom/de/", ("xcom", "/de/", None, "allow")),
    ],
)
def test_url_rules(spark, url, expected):
    r = filter_urls(spark.createDataFrame([(1, url, None)], "page_id long, url string, html string"), URL_RULES).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected


def test_url_aliases(spark):
    link = '<link href="https://b.com/de/x" rel="canonical">'
    rows = [(1, "https://n.net/1", link), (2, "https://n.net/2", '<META http-equiv=refresh content="0; url=/1">'), (3, "https://n.net/3", '<link rel=canonical href="//o.org/y">'), (4, "https://o.org/y", "<meta http-equiv='refresh' content='1;URL=https://b.com/de/z'>"), (5, "https://n.net/5", None), (5, "https://n.net/5", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    got = [(r["page_id"], r["verdict"]) for r in filter_urls(frame, URL_RULES).orderBy("page_id").collect()]
    assert got == [(1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow"), (5, "allow")]
    more = spark.createDataFrame([("https://n.net/5", "https://b.com/de/q")], "source string, target string")
    assert {r["verdict"] for r in filter_urls(frame, URL_RULES, redirects=more).where("page_id = 5").collect()} == {"block"}
    assert filter_urls(frame.limit(0), URL_RULES).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(None, 3), (5, 5)]
    root = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a is not None and a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
