"""A day's collection of several channels from a net that is a table of answers."""

from newsloom.plans import collect, cycle
from newsloom.sources.fetching import Response
from newsloom.sources.store import Store

DAY = "2024-01-05"
TEXT = "A line of this article that is long enough to be one. " * 12


def page(title, date="", text=TEXT):
    meta = f'<meta property="article:published_time" content="{date}">' if date else ""
    return f"<html><head><title>{title}</title>{meta}</head><body><article><p>{text}</p><p>{text}</p></article></body></html>"


CARD = '<article class="gridlove-post"><h2 class="entry-title"><a href="/{0}/">{0}</a></h2><b class="meta-date"><i class="updated">{1}</i></b></article>'
ITEM = "<item><title>{0}</title><link>https://feed.org/{0}</link><pubDate>{1}</pubDate><description>An excerpt that stands in for the page.</description></item>"
NET = {
    "https://plain.org/": '<ul><li><a href="/2024/01/a.html">One story of the day</a></li><li><a href="/2024/01/b.html">Another story</a></li><li><a href="/2024-01-03/old.html">An older story, by its address</a></li></ul>',
    "https://plain.org/2024/01/a.html": page("A", "2024-01-05T09:00:00+08:00"), "https://plain.org/2024/01/b.html": page("B", "January 4, 2024"),
    "https://batteries.org/": '<div class="gridlove-module"><h3>Latest</h3>' + CARD.format("c1", "January 5, 2024") + CARD.format("c2", "January 2, 2024") + '</div><a href="/page/2">load more</a>',
    "https://batteries.org/page/2": '<div class="gridlove-module"><h3>Latest</h3>' + CARD.format("c3", "January 1, 2024") + "</div>",
    "https://batteries.org/c1/": '<html><head><title>C1</title><meta name="date" content="2024-01-05"></head><body><div class="entry-content"><p>' + TEXT + "</p></div></body></html>",
    "https://feed.org/rss": "<rss><channel>" + ITEM.format("f1", "Fri, 05 Jan 2024 08:00:00 +0800") + ITEM.format("f2", "Thu, 04 Jan 2024 08:00:00 +0800") + ITEM.format("f3", "Fri, 05 Jan 2024 09:00:00 +0800") + "</channel></rss>",
    "https://feed.org/f1": page("F1"),
}


def getter(net):
    """A request that tasks take along with its answers."""

    def get(url, headers, auth):
        if url not in net:
            return Response(503 if "broken" in url else 404)
        return Response(200, net[url].encode(), {"content-type": "application/rss+xml" if url.endswith("rss") else "text/html"}, url)

    return get


SOURCES = [
    ("Plain", "https://plain.org/", "", "每日", "d", "s"), ("Batteries News", "https://batteries.org/", "", "每日", "d", "s"), ("Feed", "https://feed.org/", "RSS: https://feed.org/rss", "每日", "d", "s"),
    ("Broken", "https://broken.org/", "", "每日", "d", "s"), ("Weekly", "https://weekly.org/", "", "每周", "d", "s"), ("Closed", "https://closed.org/", "无法访问", "每日", "d", "s"),
]


def test_a_day_of_all_channels(spark, tmp_path):
    home, store = str(tmp_path / "home"), Store(spark, str(tmp_path / "articles"), "_key", buckets=2)
    sources = spark.createDataFrame(SOURCES, "name string, url string, note string, frequency string, domain string, sub_domain string")
    run = lambda now, net=NET: collect.collect(spark, home, sources, store, getter(net), DAY, now, delay=0.0, retries=0)
    health = {r["source"]: r for r in run("2024-01-05T20:00").collect()}
    got = {r["url"]: r for r in store.read().collect()}
    assert sorted(got) == ["https://batteries.org/c1/", "https://feed.org/f1", "https://feed.org/f3", "https://plain.org/2024/01/a.html"]
    assert {u: (r["title"], r["published_at"], r["content_status"]) for u, r in got.items()} == {
        "https://batteries.org/c1/": ("C1", DAY, "full"), "https://feed.org/f1": ("F1", DAY, "full"), "https://feed.org/f3": ("f3", DAY, "incomplete"), "https://plain.org/2024/01/a.html": ("A", DAY, "full"),
    }
    assert got["https://feed.org/f3"]["content_extraction"] == "rss_excerpt" and got["https://feed.org/f1"]["source_name"] == "Feed"
    assert {s: (r["status"], r["candidates_seen"], r["pages_fetched"], r["new_articles"], r["usable_articles"], r["crawl_mode"]) for s, r in health.items()} == {
        "Plain": ("healthy", 3, 2, 1, 1, "listing"), "Batteries News": ("healthy", 3, 1, 1, 1, "listing"), "Feed": ("degraded", 3, 2, 2, 1, "rss"),
        "Broken": ("failed", 0, 0, 0, 0, "listing"), "Weekly": ("failed", 0, 0, 0, 0, "listing"), "Closed": ("skipped", 0, 0, 0, 0, ""),
    }
    assert health["Broken"]["reason"] == "http 503" and "无法访问" in health["Closed"]["reason"]
    assert spark.read.json(f"{home}/source-errors").count() == 2
    # what is stored in full is not asked for again; the excerpt is, and its page is there by now
    again = {r["source"]: r for r in run("2024-01-05T21:00", NET | {"https://feed.org/f3": page("F3")}).collect()}
    assert (again["Feed"]["new_articles"], again["Feed"]["refreshed_articles"], again["Feed"]["status"]) == (0, 1, "healthy") and again["Plain"]["status"] == "zero"
    assert {r["content_status"] for r in store.read().collect()} == {"full"} and store.read().count() == 4
    out = cycle.run(spark, home, store.read, spark.createDataFrame(list(again.values())), DAY, "2024-01-05T22:00")
    stats = {r["source"]: r["crawl_status"] for r in spark.read.parquet(out["stats"]).where(f"date = '{DAY}'").collect()}
    assert stats["Plain"] == "already_collected" and stats["Broken"] == "failed"


def test_a_day_from_the_command_line(spark, tmp_path, monkeypatch):
    import json

    from newsloom import cli
    from newsloom.sources import fetching, files

    header = list(files.SOURCE_HEADERS.values())
    rows = [["Feed", "", "d", "s", "每日", "", "RSS: https://feed.org/rss", "https://feed.org/"], ["Broken", "", "", "", "每日", "", "", "https://broken.org/"]]
    (tmp_path / "s.xlsx").write_bytes(files.write_workbook({"S": (header, rows)}))
    monkeypatch.setattr(fetching, "http_get", getter(NET))
    args = ["collect", "--home", str(tmp_path / "home"), "--sources", str(tmp_path / "s.xlsx"), "--store", str(tmp_path / "t"), "--day", DAY, "--delay", "0"]
    assert cli.main([*args, "--only", "Feed"]) == 1  # an excerpt makes the channel degraded
    assert cli.main([*args, "--only", "Nobody"]) == 2
    told = json.loads((tmp_path / "home" / "channel-health.json").read_text(encoding="utf-8"))
    assert [(s["source"], s["new_articles"]) for s in told["sources"]] == [("Feed", 2)] and told["target_date"] == DAY
    assert cli.table(spark, str(tmp_path / "t")).count() == 2
