import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import audit, classify, incidents
from newsloom.plans import registry
from newsloom.sources import edges, feeds, files

D = dt.date


def days(spark, rows):
    """Rows of (date, source, count, frequency, status)."""
    df = spark.createDataFrame(rows, "date date, source string, article_count long, frequency string, crawl_status string")
    return df.withColumn("expected_daily", F.lit(True)).withColumn("usable_articles", F.col("article_count")).withColumn("duplicate_articles", F.lit(0).cast("long"))


def test_streak_and_anomalies(spark):
    rows = [(D(2026, 8, k), "a", n, "每日", "zero" if n == 0 else "healthy") for k, n in ((1, 3), (2, 4), (3, 0), (4, 0))]
    rows += [(D(2026, 8, k), "b", n, "每日", "healthy") for k, n in ((1, 3), (2, 3), (3, 8))]
    out = audit.channel_anomalies(audit.zero_streak(audit.with_baseline(days(spark, rows), "article_count", "source")))
    got = {(r["source"], r["date"].day): (r["zero_streak_days"], r["anomaly_codes"], r["anomaly_level"]) for r in out.collect()}
    assert got["a", 3] == (1, "sudden_zero", "critical")
    assert got["a", 4] == (2, "sudden_zero,zero_2d", "critical")
    assert got["b", 3] == (0, "surge_2x", "warning")
    assert got["b", 1] == (0, "", "normal")


def test_streak_passes_over_free_days(spark):
    rows = [(D(2024, 1, k), "a", 0, "工作日", "zero") for k in (4, 5, 6, 7, 8)]
    got = {r["date"].day: r["zero_streak_days"] for r in audit.zero_streak(days(spark, rows)).collect()}
    assert got[8] == 3  # Monday, Friday and Thursday; the weekend does not count


def test_inventory_median(spark):
    rows = [("full", "x" * 120, "u1"), ("full", "x" * 800, "u1"), (None, None, "")]
    df = spark.createDataFrame(rows, "content_status string, content string, key string").withColumn("source_name", F.lit(" s ")).withColumn("date", F.lit("2024-01-01").cast("date"))
    r = audit.inventory(df, "date", "key").first()
    assert (r["article_count"], r["unique_articles"], r["duplicate_articles"], r["usable_articles"], r["content_chars_median"], r["short_articles"], r["source"]) == (3, 1, 2, 2, 120, 2, "s")
    assert audit.inventory(df.limit(0), "date", "key").count() == 0


def test_gap(spark):
    stats = days(spark, [(D(2026, 7, 26), "a", 1, "每日", "healthy"), (D(2026, 7, 28), "a", 1, "每日", "healthy"), (D(2026, 7, 26), "h", 1, "每日", "historical"), (D(2026, 7, 28), "h", 1, "每日", "historical")])
    gaps = audit.missing_runs(stats, audit.daily_summary(stats), stats).collect()
    assert [(r["date"], r["source"]) for r in gaps] == [(D(2026, 7, 27), "a")]
    assert audit.missing_runs(stats.limit(0), audit.daily_summary(stats.limit(0)), stats.limit(0)).count() == 0


def record(seq, key, status, content, cls="", title="t", source="s"):
    return (seq, key, status, content, cls, title, source)


SCHEMA = "seq long, key string, content_status string, content string, industry_classification_status string, title string, source_name string"


def test_best_and_upsert(spark):
    stored = spark.createDataFrame([record(1, "a", "incomplete", "x" * 1200, "classified"), record(2, "b", "incomplete", "x" * 10), record(3, "b", "full", "kept copy"), record(4, "c", "full", "x" * 9)], SCHEMA)
    new = spark.createDataFrame([record(10, "a", "full", "x" * 900, "error"), record(11, "a", "missing", "x" * 9999), record(12, "b", "unknown", "x" * 5), record(13, "d", "missing", ""), record(14, "c", "full", "x" * 9)], SCHEMA)
    out = {(r["key"], r["seq"]): r for r in A.upsert(stored, new, "key", "seq").collect()}
    assert out["a", 1]["change"] == "updated" and len(out["a", 1]["content"]) == 900 and out["a", 1]["industry_classification_status"] == "classified"
    assert out["b", 2]["change"] == "kept" and out["b", 3]["content"] == "kept copy"
    assert out["c", 4]["change"] == "kept" and out["d", 13]["change"] == "added"
    again = {(r["key"], r["seq"]): r["change"] for r in A.upsert(A.upsert(stored, new, "key", "seq").drop("change"), new, "key", "seq").collect()}
    assert set(again.values()) == {"kept"}


def test_fold_with_placeholder(spark):
    rows = spark.createDataFrame([record(1, "a", "full", "x" * 50, title="NE时代", source="NE时代"), record(2, "a", "full", "x" * 10, title="Real", source="NE时代"), record(3, "a", "full", "x" * 5, title="Other", source="NE时代")], SCHEMA)
    assert A.fold_best(rows, "key", "seq", "source_name", "ne时代").first()["title"] == "Real"


def test_fold_against_a_loop(spark):
    import random

    rng = random.Random(3)
    rows = []
    for seq in range(600):
        source = rng.choice(["NE时代", "other"])
        rows.append(record(seq, rng.choice("abcdefgh") * rng.randint(1, 3) if seq % 50 else None, rng.choice(["full", "incomplete", "missing", "unknown"]), "x" * rng.randint(1, 6), title=rng.choice(["NE时代", "", f"T{seq}"]), source=source))
    rank, tier = {"full": 3, "incomplete": 2, "missing": 0}, {"full": 2, "missing": 0}
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    records = sorted((r.asDict() for r in frame.collect()), key=lambda r: r["seq"])
    worth = lambda r: (tier.get(r["content_status"], 1), len(r["content"].strip()) if tier.get(r["content_status"], 1) else 0)
    best = {}
    for r in records:
        old = best.get(r["key"])
        open_ = old and old["source_name"].lower() == old["title"].lower() == "ne时代"
        if old is None or open_ and r["title"] not in ("", "NE时代") and rank.get(r["content_status"], 1) >= rank.get(old["content_status"], 1) or worth(r) > worth(old):
            best[r["key"]] = r
    got = {r["key"]: r["seq"] for r in A.fold_best(frame, "key", "seq", "source_name", "ne时代").collect()}
    assert got == {k: r["seq"] for k, r in best.items()}


def test_incident_cycle(spark):
    stats = days(spark, [(D(2024, 1, 1), "a", 0, "每日", "failed"), (D(2024, 1, 1), "b", 5, "每日", "healthy"), (D(2024, 1, 1), "c", 0, "每日", "zero")])
    queue = spark.createDataFrame([("2024-01-01::b", D(2024, 1, 1), "b", "recovery_failed", 2, 0, "timeout", "x"), ("2024-01-01::c", D(2024, 1, 1), "c", "ignored", 0, 0, "x", "x")], "id string, date date, source string, status string, attempts long, recovered_articles long, diagnosis_code string, updated_at string")
    health = spark.createDataFrame([("a", "missing run record", 0, 0)], "source string, reason string, candidates_seen long, pages_fetched long")
    q = incidents.sync(stats, queue, health, F.lit("now"))
    got = {r["source"]: (r["status"], r["diagnosis_code"]) for r in q.collect()}
    assert got == {"a": ("pending_confirmation", "missing_run_record"), "b": ("recovered", "timeout"), "c": ("ignored", "no_candidates")}
    done = incidents.finish(incidents.auto_confirm(q), stats.withColumn("article_count", F.lit(3).cast("long")))
    assert {r["source"]: (r["status"], r["attempts"]) for r in done.collect()}["a"] == ("recovered", 1)
    changes = incidents.status_changes(q, spark.createDataFrame([("2024-01-01::b", "recovered")], "id string, status string"))
    assert [r["source"] for r in changes.collect()] == ["a"]
    sent = []
    assert edges.deliver(changes, lambda m: sent.append(m) or True) and "a: pending_confirmation" in sent[0]


def test_classifier(spark):
    rows = spark.createDataFrame([(str(k),) for k in range(7)], "article_id string").withColumn("payload", classify.payload(F.lit("t"), F.lit("s"), F.lit("c"))).coalesce(1)

    def client(batch):
        if len(batch) > 2:
            return "no json"
        return "Here: " + json.dumps({"results": [{"article_id": b["article_id"], "matches": []} for b in batch if b["article_id"] != "3"]})

    got = {r["article_id"]: r["error"] for r in classify.classify(rows, client).collect()}
    assert got["3"] and not any(e for k, e in got.items() if k != "3")

    def dead(batch):
        raise classify.PermanentClassifierError("no key")

    assert {r["error"] for r in classify.classify(rows, dead).collect()} == {"no key"}


RSS = """<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><item><title>A</title><link>https://h/a</link><description>short</description><content:encoded>full text</content:encoded><pubDate>x</pubDate></item>
<item><title>no link</title></item></channel></rss>"""


def test_feeds(spark):
    assert feeds.parse_feed(RSS) == [("A", "https://h/a", "x", "full text", True)]
    assert feeds.parse_feed("<broken") == []
    rows = feeds.entries(spark.createDataFrame([(1, RSS), (2, None)], "id int, body string")).collect()
    assert [(r["id"], r["url"]) for r in rows] == [(1, "https://h/a")]
    assert feeds.candidate_feeds("https://h/news", iter([("application/rss+xml", "/own")]))[0] == "https://h/own"


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"title": "x", "url": "u"}\nbroken\n', encoding="utf-8")
    assert files.read_articles(spark, str(tmp_path / "a.jsonl")).where("url = 'u'").count() == 1
    assert files.read_articles(spark, str(tmp_path / "a.jsonl"), keep_malformed=True).select("url", "_corrupt").collect()[1]["_corrupt"] == "broken"
    (tmp_path / "articles-2024-01-02.csv").write_text('﻿title,url\n"two\nlines",u\n', encoding="utf-8")
    row = files.read_csv(spark, str(tmp_path / "articles-2024-01-02.csv"), ["title", "url", "domain"]).withColumn("day", files.file_date(F.col("_file"))).first()
    assert (row["title"], row["domain"], row["day"]) == ("two\nlines", "", D(2024, 1, 2))
    headers = list(files.SOURCE_HEADERS.values())
    (tmp_path / "s.xlsx").write_bytes(files.write_workbook({"s": (headers, [["n", "", "", "", "每日", "", "", "https://x"], [""] * 8])}))
    assert [(r["name"], r["url"]) for r in files.read_sources(spark, str(tmp_path / "s.xlsx")).collect()] == [("n", "https://x")]
    state = files.write_version(spark.range(3).toDF("id"), str(tmp_path / "state"), "0001")
    assert files.latest_version(spark, str(tmp_path / "state")).endswith("version=0000000001-0001") and spark.read.parquet(state).count() == 3
    again = files.write_version(spark.read.parquet(state).limit(2), str(tmp_path / "state"), "0001")  # a label that is there is no reason to overwrite
    assert again != state and files.latest_version(spark, str(tmp_path / "state")).endswith(again.rpartition("/")[2])
    assert spark.read.parquet(state).count() == 3 and spark.read.parquet(again).count() == 2


def test_export_and_download(spark, tmp_path):
    rows = spark.createDataFrame([("t", D(2024, 1, 1), ["x"]), ("u", D(2024, 1, 2), None)], "title string, day date, tags array<string>")
    path = files.export_day(rows, str(tmp_path), D(2024, 1, 1), ["title", "tags"], F.col("day"))
    assert [(r["title"], r["tags"]) for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()] == [("t", '["x"]')]
    book = files.write_workbook({"a": (["h"], [[i] for i in range(300)])})
    assert edges.download_workbook(lambda: "token", lambda t: book) == book
    with pytest.raises(ValueError):
        edges.download_workbook(lambda: "token", lambda t: b"<html>")


def test_streaming_upsert_is_idempotent(spark, tmp_path):
    from newsloom.sources.store import Store
    from newsloom.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    for k, (url, text) in enumerate([("https://h.org/u", "short"), ("https://h.org/u?utm_source=x", "longer text")]):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"url": url, "content": text, "content_status": "unknown"}) + "\n")
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    table = Store(spark, str(tmp_path / "t"), "_key")
    assert [r["content"] for r in table.read().collect()] == ["longer text"]
    batch = spark.createDataFrame([("https://h.org/v", "again", "full", 0)], "_key string, content string, content_status string, _seq long")
    assert table.put(batch, label="batch0") == {"added": 0, "updated": 0, "kept": 0, "read": 0}  # that batch is in


def test_limit_follows_the_dates(spark, tmp_path):
    """LIM-1 for all days: seven dated articles of a day leave five, in the first days of the month too; undated ones none."""
    docs = [(i, "text", "en", "a" if i % 30 else "b") for i in range(0, 420)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["source_name"], r["date"], r["seq"]) for r in registry.queries()["per_source_limit"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(f"SELECT source_name, date, seq FROM ({registry.oracle_sql()['per_source_limit']})").fetchall())
    days = {(source, day) for source, day, _ in got}
    assert len([k for k in got if k[:2] == ("b", D(2024, 1, 1))]) == 5 and {day for _, day in days} == {D(2024, 1, 1) + dt.timedelta(k) for k in range(30)}
    assert not any(seq % 4 == 1 and seq % 3 for _, _, seq in got)
