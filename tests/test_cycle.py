import datetime as dt

from newsloom import cli
from newsloom.plans import cycle
from newsloom.sources import listings


def test_a_day_run_again(spark, tmp_path):
    home = str(tmp_path)
    articles = spark.createDataFrame([("2024-01-04", "https://a/1", "a", "full", "x" * 600)], "published_at string, url string, source_name string, content_status string, content string")
    health = spark.createDataFrame([("a", "每日", "healthy", "", 1, 1), ("b", "每日", "failed", "HTTP 403", 0, 0)], "source string, frequency string, status string, reason string, candidates_seen long, pages_fetched long")

    def tables(out):
        return {name: sorted(str({k: v for k, v in r.asDict().items() if k not in ("updated_at", "notified_at")}) for r in spark.read.parquet(path).collect()) for name, path in out.items()}

    sent = []
    run = lambda now: cycle.run(spark, home, articles, health, "2024-01-04", now, send=lambda m: sent.append(m) or True)
    first = run("2024-01-04T08")
    before = tables(first)
    for now in ("2024-01-04T09", "2024-01-04T09", "2023-12-31T00"):  # later, once more, and with a clock gone back
        again = tables(run(now))
        assert again == {k: v for k, v in before.items() if k in again} and len(sent) == 1
    assert tables(first) == before  # what was read is still there
    ledger = before["ledger"]
    assert len(ledger) == len(set(ledger)) == 2
    assert cli.main(["resolve", "--home", home, "ignore", "2024-01-04::b"]) == 0
    out = run("2024-01-04T10")
    assert [r["status"] for r in spark.read.parquet(out["queue"]).collect()] == ["ignored"]
    half = tmp_path / "queue" / "version=0000000099-2024-01-05"  # a write that did not end
    half.mkdir()
    assert [r["status"] for r in spark.read.parquet(run("2024-01-04T11")["queue"]).collect()] == ["ignored"]


def test_cycle_over_days(spark, tmp_path):
    home = str(tmp_path)
    articles = spark.createDataFrame([("2024-01-04", "https://a/1", "a", "full", "x" * 600), ("2024-01-05", "https://a/2", "a", "full", "x" * 600)], "published_at string, url string, source_name string, content_status string, content string")
    schema = "source string, frequency string, status string, reason string, candidates_seen long, pages_fetched long"

    def day(date, now, rows, **edges):
        return cycle.run(spark, home, articles, spark.createDataFrame(rows, schema), date, now, **edges)

    day("2024-01-04", "2024-01-04T08", [("a", "每日", "healthy", "", 1, 1), ("b", "每日", "healthy", "", 1, 1)])
    sent = []
    rows = [("a", "每日", "healthy", "", 1, 1), ("b", "每日", "failed", "HTTP 403; password=x", 0, 0)]
    first = day("2024-01-05", "2024-01-05T08", rows, send=lambda m: sent.append(m) or True)
    state = {r["source"]: (r["last_status"], r["next_action"], r["consecutive_unhealthy"]) for r in spark.read.parquet(first["state"]).collect()}
    assert state["a"] == ("healthy", "none", 0) and state["b"] == ("failed", "repair_then_confirm", 1)
    queue = spark.read.parquet(first["queue"]).collect()
    assert [(r["id"], r["status"], r["diagnosis_code"]) for r in queue] == [("2024-01-05::b", "pending_confirmation", "access_denied")]
    assert len(sent) == 1 and "2024-01-05 b" in sent[0]
    assert {r["reason"] for r in spark.read.parquet(first["ledger"]).where("source = 'b' AND status = 'failed'").collect()} == {"HTTP 403; password=[REDACTED]"}
    later = day("2024-01-06", "2024-01-06T08", [("a", "每日", "healthy", "", 1, 1), ("b", "每日", "failed", "", 0, 0)], send=lambda m: sent.append(m) or True)
    state = {r["source"]: r["consecutive_unhealthy"] for r in spark.read.parquet(later["state"]).collect()}
    assert state == {"a": 0, "b": 2} and len(sent) == 2
    assert cli.main(["check", "--home", home]) == 1 and cli.main(["check", "--home", home, "--warn-only"]) == 0
    assert cli.main(["resolve", "--home", home, "ignore", "2024-01-05::b"]) == 0
    assert cli.main(["resolve", "--home", home, "ignore", "unknown"]) == 1


def test_listings(spark):
    rows = [
        ("InsideEVs", "https://insideevs.com/news/", 0, 0, "https://insideevs.com/about", "A long enough title"),
        ("InsideEVs", "https://insideevs.com/news/", 0, 1, "https://www.insideevs.com/news/12/a-b/", "x"),
        ("any", "https://h.org/", 0, 0, "https://h.org/plain/path", "A long enough title"),
        ("any", "https://h.org/", 0, 1, "https://h.org/2024/05/x.html", ""),
        ("any", "https://h.org/", 1, 0, "https://h.org/2024/05/x.html", ""),
        ("any", "https://h.org/", 1, 1, "https://other.org/2024/05/y.html", ""),
    ]
    links = spark.createDataFrame(rows, "name string, page_url string, page_no int, pos int, link string, title string")
    got = [(r["name"], r["link"], r["rank"]) for r in listings.article_links(links, spark).orderBy("name", "rank").collect()]
    assert got == [("InsideEVs", "https://www.insideevs.com/news/12/a-b/", 1), ("any", "https://h.org/2024/05/x.html", 1), ("any", "https://h.org/plain/path", 2)]
    pages = listings.listing_pages(spark.createDataFrame([("H2 View", "https://h2/"), ("any", "https://h.org/")], "name string, url string"), spark)
    assert pages.count() == 3
    cards = spark.createDataFrame([(0, 0, dt.date(2024, 1, 3)), (0, 1, dt.date(2024, 1, 2)), (1, 0, dt.date(2024, 1, 2)), (2, 0, dt.date(2024, 1, 1)), (3, 0, dt.date(2024, 1, 2))], "page_no int, pos int, published_date date")
    from pyspark.sql import functions as F

    assert [(r["page_no"], r["pos"]) for r in listings.until_older(cards, F.lit("2024-01-02").cast("date"), 9).collect()] == [(0, 1), (1, 0)]
