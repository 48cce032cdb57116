"""The stored article table: merges, what a batch reads and writes, snapshots, writers at once, compaction."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.sources import store
from newsloom.sources.store import Store

SCHEMA = "url string, content string, content_status string, _seq long"
RANK = {"full": 2, "missing": 0}


def batch(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def worth(row):
    tier = RANK.get(row[2], 1)
    return tier, len(row[1].strip()) if tier else 0


def plain(batches):
    out = {}
    for rows in batches:
        for r in rows:
            if r[0] not in out or worth(r) > worth(out[r[0]]):
                out[r[0]] = r
    return sorted(out.values())


def content(table, number=None):
    return sorted((r["url"], r["content"], r["content_status"]) for r in table.read(number).collect())


def test_batches_against_a_loop(spark, tmp_path):
    rng = random.Random(1)
    one = lambda: (f"u{rng.randrange(40)}", "x" * rng.randrange(1, 30), rng.choice(["full", "missing", "unknown"]))
    table, batches = Store(spark, str(tmp_path), "url", buckets=4), []
    assert table.read() is None and table.compact() == []
    for size in (25, 1, 20, 0):
        batches.append([one() for _ in range(size)])
        before = len(plain(batches[:-1]))
        done = table.put(batch(spark, batches[-1]))
        assert content(table) == plain(batches) and done["added"] == len(plain(batches)) - before
    first = plain(batches[:1])
    assert content(table, 1) == first  # a reader of an old snapshot is not disturbed
    whole = content(table)
    assert table.compact(dead=2, commits=99) == []  # nothing is bad enough
    taken = table.compact(dead=0.0, commits=1)
    assert taken and content(table) == whole and content(table, 1) == first
    batches.append([one() for _ in range(30)])
    table.put(batch(spark, batches[-1]))
    assert content(table) == plain(batches)
    assert table.compact(dead=-1) == [0, 1, 2, 3] and len(table.snapshot().data) == 1
    assert table.vacuum() and content(table) == plain(batches)
    table.put(batch(spark, batches[0]))
    assert content(table) == plain(batches)


def test_a_batch_costs_what_it_changes(spark, tmp_path):
    table = Store(spark, str(tmp_path), "url", buckets=16)
    stored = spark.range(20_000).select(F.concat(F.lit("https://h.org/"), "id").alias("url"), F.lit("some text").alias("content"), F.lit("unknown").alias("content_status"), F.col("id").alias("_seq"))
    assert table.put(stored)["added"] == 20_000
    few = spark.range(200).select(F.concat(F.lit("https://h.org/"), F.col("id") * 20).alias("url"), F.lit("a longer text than before").alias("content"), F.lit("unknown").alias("content_status"), F.col("id").alias("_seq"))
    done = table.put(few)  # one percent of the keys, from all over the table
    assert (done["added"], done["updated"], done["kept"], done["read"]) == (0, 200, 0, 200)
    size = lambda c: sum(f.stat().st_size for f in (tmp_path / "data" / f"commit={c}").rglob("*.parquet"))
    first, second = table.snapshot().data
    assert size(second) < 0.2 * size(first)  # sixteen small files, most of which is what a file has to say of itself
    rows = spark.read.option("basePath", str(tmp_path / "data")).parquet(str(tmp_path / "data"))
    assert rows.groupBy("commit").count().where(F.col("commit") == second).first()["count"] == 200
    assert table.read().count() == 20_000 and table.read().where("content LIKE 'a longer%'").count() == 200
    new = spark.range(300).select(F.concat(F.lit("https://other.org/"), "id").alias("url"), F.lit("t").alias("content"), F.lit("").alias("content_status"), F.col("id").alias("_seq"))
    hits = table.may_hold(new, table.snapshot()).count()
    assert hits < 0.05 * 300 * 2  # the filters rule nearly all of them out
    assert table.may_hold(stored.limit(500), table.snapshot()).where(F.col("commit") == first).count() == 500  # and never one that is there
    assert table.put(new)["added"] == 300


def test_writers_at_once(spark, tmp_path, monkeypatch):
    ours, theirs = (Store(spark, str(tmp_path), "url", buckets=2) for _ in range(2))
    ours.put(batch(spark, [("a", "xx", "unknown")]))
    merge, times = ours._merge, []

    def meanwhile(incoming, state, commit):  # another writer commits between our reading and our commit
        out = merge(incoming, state, commit)
        if not times:
            theirs.put(batch(spark, [("a", "xxxx", "unknown"), ("b", "x", "unknown")]))
        times.append(state.number)
        return out

    monkeypatch.setattr(ours, "_merge", meanwhile)
    done = ours.put(batch(spark, [("a", "xxx", "unknown"), ("c", "x", "unknown")]), label="one")
    assert times == [1, 2] and (done["added"], done["updated"], done["kept"]) == (1, 0, 1)
    assert content(ours) == [("a", "xxxx", "unknown"), ("b", "x", "unknown"), ("c", "x", "unknown")]
    assert ours.put(batch(spark, [("z", "z", "full")]), label="one")["added"] == 0 and ours.snapshot().number == 3
    monkeypatch.setattr(ours, "_commit", lambda after: False)
    with pytest.raises(store.Conflict):
        ours.put(batch(spark, [("d", "x", "full")]), tries=2)
    (tmp_path / "_log" / "0000000009.json").write_text('{"number": 9, "data": [')  # a writer that died while it wrote
    assert theirs.snapshot().number == 3 and len(content(theirs)) == 3
