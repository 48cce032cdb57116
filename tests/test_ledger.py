"""The ledger, its fold in batch and as a stream, and a cycle whose backfill writes articles."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import incidents, ledger
from newsloom.plans import cycle
from newsloom.sources.files import claim, latest_version, write_version
from newsloom.streaming import channel_state

ARTICLE = "published_at string, url string, source_name string, content_status string, content string"
HEALTH = "source string, frequency string, status string, reason string, candidates_seen long, pages_fetched long, generated_at string"
FIELDS = [f.rsplit(" ", 1)[0] for f in ledger.CHANNEL.split(", ")]


def article(day, source, n=1):
    return (f"{day}", f"https://{source}/{day}/{n}", source, "full", "x" * 600)


def rows(spark, path, *columns):
    return sorted(tuple(r[c] for c in columns) for r in spark.read.parquet(path).collect())


class Home:
    """A cycle over an article table in files, which a backfill adds to."""

    def __init__(self, spark, path):
        self.spark, self.path, self.table = spark, str(path / "home"), str(path / "articles")

    def add(self, *articles):
        self.spark.createDataFrame(articles, ARTICLE).coalesce(1).write.mode("append").parquet(self.table)

    def day(self, day, health, **edges):
        told = [(s, "每日", status, reason, 1, 1, f"{day}T07") for s, status, reason in health]
        return cycle.run(self.spark, self.path, lambda: self.spark.read.parquet(self.table), self.spark.createDataFrame(told, HEALTH), day, f"{day}T08", **edges)


def test_backfill_that_writes_files(spark, tmp_path):
    home = Home(spark, tmp_path)
    home.add(article("2024-01-01", "a"), article("2024-01-01", "b"))
    home.day("2024-01-01", [("a", "healthy", ""), ("b", "healthy", "")])
    # nothing runs on the 2nd; on the 3rd b fails, and the gaps of the 2nd are filled for a alone
    home.add(article("2024-01-03", "a"))
    asked = []

    def fill(confirmed):
        asked.extend(sorted(r["id"] for r in confirmed.collect()))
        assert rows(spark, latest_version(spark, f"{home.path}/queue"), "id", "status", "attempts")[0] == ("2024-01-02::a", "recovering", 1)
        home.add(article("2024-01-02", "a"))

    out = home.day("2024-01-03", [("a", "healthy", ""), ("b", "failed", "HTTP 403")], backfill=fill)
    assert asked == ["2024-01-02::a", "2024-01-02::b"]
    got = rows(spark, out["queue"], "id", "status", "diagnosis_code", "attempts", "recovered_articles", "last_error")
    assert got == [
        ("2024-01-02::a", "recovered", "missing_run_record", 1, 1, ""),
        ("2024-01-02::b", "recovery_failed", "missing_run_record", 1, 0, incidents.STILL_EMPTY),
        ("2024-01-03::b", "pending_confirmation", "access_denied", 0, 0, ""),
    ]
    notes = {r["id"]: r["confirmation_note"] for r in spark.read.parquet(out["queue"]).collect()}
    assert notes["2024-01-02::a"] == incidents.AUTO_NOTE and notes["2024-01-03::b"] == ""
    events = cycle.events(spark, home.path)
    assert sorted((r["seq"], r["source"], r["status"]) for r in events.collect()) == [(1, "a", "healthy"), (2, "b", "healthy"), (3, "a", "missing_run"), (4, "b", "missing_run"), (5, "a", "healthy"), (6, "b", "failed")]
    state = {r["source"]: (r["last_status"], r["previous_status"], r["open_incidents"], r["next_action"], str(r["last_success_date"])) for r in spark.read.parquet(out["state"]).collect()}
    assert state == {"a": ("healthy", "healthy", 0, "none", "2024-01-03"), "b": ("failed", "healthy", 2, "repair_then_reconfirm", "2024-01-01")}
    # articles of the 2nd and 3rd come late: old incidents are closed although neither day is today's
    home.add(article("2024-01-02", "b"), article("2024-01-03", "b"), article("2024-01-04", "a"), article("2024-01-04", "b"))
    out = home.day("2024-01-04", [("a", "healthy", ""), ("b", "healthy", "")])
    assert {r[1] for r in rows(spark, out["queue"], "id", "status")} == {"recovered"}
    assert cycle.events(spark, home.path).count() == 8
    again = home.day("2024-01-04", [("a", "healthy", ""), ("b", "healthy", "")])
    assert "ledger" not in again and rows(spark, again["state"], *FIELDS) == rows(spark, out["state"], *FIELDS)
    assert sorted(map(str, ledger.replay(cycle.events(spark, home.path)).select(FIELDS).collect())) == sorted(map(str, spark.read.parquet(again["state"]).select(FIELDS).collect()))


def test_attempts_that_died_are_taken_up_again(spark, tmp_path):
    home = Home(spark, tmp_path)
    home.add(article("2024-01-01", "a"), article("2024-01-03", "a"))
    home.day("2024-01-01", [("a", "healthy", "")])

    def dies(confirmed):
        raise OSError("no network")

    with pytest.raises(OSError, match="no network"):
        home.day("2024-01-03", [("a", "healthy", "")], backfill=dies)
    assert rows(spark, latest_version(spark, f"{home.path}/queue"), "id", "status", "attempts") == [("2024-01-02::a", "recovering", 1)]
    said = lambda confirmed: confirmed.select("id", F.lit(3).alias("exit_code"), F.lit("").alias("reason"))
    out = home.day("2024-01-03", [("a", "healthy", "")], backfill=said)
    assert rows(spark, out["queue"], "status", "attempts", "last_error") == [("recovery_failed", 2, "补抓命令退出码为 3")]


def test_a_day_that_no_audit_covers_has_no_gaps(spark):
    from newsloom.operators import audit

    day = lambda n: dt.date(2024, 1, n)
    stats = spark.createDataFrame([(day(1), "a", "每日", "healthy", 3, 3, True), (day(4), "a", "每日", "healthy", 3, 3, True)], "date date, source string, frequency string, crawl_status string, article_count long, usable_articles long, expected_daily boolean")
    gaps = lambda latest: sorted(str(r["date"]) for r in audit.missing_runs(stats, audit.daily_summary(stats), stats, latest=F.lit(latest).cast("date")).collect())
    assert gaps("2024-01-04") == ["2024-01-02", "2024-01-03"] and gaps("2024-01-03") == [] and gaps("2024-01-01") == []


def history(n=400, channels=7, seed=3):
    rng = np.random.default_rng(seed)
    kinds = ["healthy", "failed", "zero", "degraded", "idle", "skipped", "missing_run", "recovered"]
    out = []
    for seq in range(1, n + 1):
        status = str(rng.choice(kinds, p=[0.2, 0.25, 0.2, 0.1, 0.05, 0.05, 0.1, 0.05]))
        out.append((f"id{seq}", seq, "now", f"at{seq}", dt.date(2024, 1, 1) + dt.timedelta(days=seq // channels), f"c{rng.integers(0, channels)}", str(rng.choice(["", "每日"])), status, f"r{seq}", "", "rss", *[int(x) for x in rng.integers(0, 9, len(ledger.COUNTS))]))
    return out


def told(states):
    return sorted(str(tuple(r[c] for c in FIELDS)) for r in states.collect())


def test_fold_in_batch_in_parts_and_by_loop(spark):
    past = history()
    events = spark.createDataFrame(past, ledger.EVENT).repartition(6)
    whole = told(ledger.replay(events))
    state = spark.createDataFrame([], ledger.CHANNEL)
    for lo, hi in ((0, 1), (1, 120), (120, 121), (100, 400)):  # the last batch brings some events again
        state = spark.createDataFrame(ledger.advance(state, events.where(f"seq > {lo} AND seq <= {hi}")).collect(), ledger.CHANNEL)
    assert told(state) == whole
    names = [f.rsplit(" ", 1)[0] for f in ledger.EVENT.split(", ")]
    by_loop = {}
    for e in (dict(zip(names, row, strict=True)) for row in past):
        if e["status"] != ledger.MISSING:
            by_loop[e["source"]] = channel_state.step(by_loop.get(e["source"]), e)
    assert sorted(str((s, *(v[c] for c in FIELDS[1:]))) for s, v in by_loop.items()) == whole
    assert ledger.replay(spark.createDataFrame([], ledger.EVENT)).count() == 0


def test_fold_as_a_stream(spark, tmp_path):
    past = history(120, 3)
    folder, out, at = (str(tmp_path / n) for n in ("ledger", "out", "checkpoint"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for part in (past[:70], past[70:]):  # the second part arrives after the first has been followed
            write_version(spark.createDataFrame(part, ledger.EVENT), folder, "run")
            channel_state.follow(spark, folder, out, at).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert told(channel_state.latest(spark.read.schema(ledger.CHANNEL).parquet(f"{out}/batch=*"))) == told(ledger.replay(spark.createDataFrame(past, ledger.EVENT)))


def test_events_are_known_by_their_id(spark):
    health = spark.createDataFrame([("a", "每日", "failed", "api_key=abc, HTTP 500", 0, 0, "2024-01-02T07", dt.date(2024, 1, 2)), ("b", "每日", "zero", "x", 0, 0, "2024-01-02T07", dt.date(2024, 1, 2)), ("", "", "zero", "", 0, 0, "", dt.date(2024, 1, 2))], HEALTH + ", date date")
    queue = spark.createDataFrame([("2024-01-02::b", dt.date(2024, 1, 2), "b", "ignored")], "id string, date date, source string, status string")
    told = ledger.attempt_events(health, queue, F.lit("now"))
    fresh = ledger.append(told, spark.createDataFrame([], cycle.SEEN), 10)
    got = {r["source"]: r for r in fresh.collect()}
    assert {s: (r["seq"], r["status"], r["reason"]) for s, r in got.items()} == {"a": (11, "failed", "api_key=[REDACTED], HTTP 500"), "b": (12, "verified_no_news", ledger.SETTLED["verified_no_news"])}
    lines = ("2024-01-02T07", "2024-01-02", "a", "failed", "api_key=[REDACTED], HTTP 500", "0")
    assert got["a"]["id"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()[:24]
    seen = ledger.remember(spark.createDataFrame([("old", 9), ("older", 8)], cycle.SEEN), fresh, keeps=3)
    assert sorted(r["id"] for r in seen.collect()) == sorted([got["a"]["id"], got["b"]["id"], "old"])
    assert ledger.append(told, seen, 12).count() == 0


def test_two_writers_take_two_numbers(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert [claim(spark, folder) for _ in range(3)] == [1, 2, 3]  # nothing is written yet, still no number is given twice
    assert latest_version(spark, folder) is None
    assert write_version(spark.range(1), folder, "x").endswith("version=0000000004-x") and latest_version(spark, folder).endswith("-x")
