"""Polite fetching by an injected clock and client, feeds with faults, and dates in free text."""

import datetime as dt

import pytest

from newsloom.functions.free_dates import free_date, read
from newsloom.sources import feeds, fetching
from newsloom.sources.fetching import Fetcher, Host, RequiredFetchError, Response


class Clock:
    def __init__(self):
        self.at = 100.0

    def now(self):
        return self.at

    def sleep(self, seconds):
        self.at += seconds


PAGE = b"<html><body><p>A page that is there.</p></body></html>"
HTML = {"Content-Type": "text/html; charset=utf-8"}


class Net:
    """Answers by address: a response, or several in turn; remembers when each was asked."""

    def __init__(self, clock, answers):
        self.clock, self.answers, self.asked = clock, answers, []

    def __call__(self, url, headers, auth):
        self.asked.append((round(self.clock.now() - 100, 3), url, headers["User-Agent"], auth))
        self.clock.at += 0.25  # what an answer takes
        found = self.answers.get(url, Response(404))
        found = found.pop(0) if isinstance(found, list) else found
        if isinstance(found, Exception):
            raise found
        return found


def fetched(answers, urls, **options):
    clock = Clock()
    net = Net(clock, answers)
    fetcher = Fetcher(net, clock, **options)
    return {row["url"]: got for row, got in fetcher.run([{"url": u} for u in urls])}, net


def test_hosts_have_their_own_pace():
    pages = {f"https://{h}.org/{k}": Response(200, PAGE, HTML) for h in "ab" for k in range(3)}
    got, net = fetched(pages, sorted(pages), delay=2.0)
    assert all(g[3] == PAGE.decode() and g[4] is None for g in got.values())
    times = {}
    for at, url, *_ in net.asked:
        times.setdefault(url.split("/")[2], []).append(at)
    assert all(len(ts) == 4 and all(b - a >= 2.25 for a, b in zip(ts, ts[1:], strict=False)) for ts in times.values())  # robots and three pages
    assert [u.split("/")[2] for _, u, *_ in net.asked[2:]] == ["a.org", "b.org"] * 3 or net.asked[-1][0] < 10  # one goes on while the other waits
    assert sum(u.endswith("robots.txt") for _, u, *_ in net.asked) == 2


def test_retries_wait_longer_and_longer():
    bad = Response(503)
    got, net = fetched({"https://h.org/x": [bad, OSError("reset"), bad, Response(200, PAGE, HTML)]}, ["https://h.org/x"], delay=0.5, respect_robots=False)
    assert got["https://h.org/x"][4:] == (None, 4)
    at = [t for t, *_ in net.asked]
    assert [round(b - a, 2) for a, b in zip(at, at[1:], strict=False)] == [0.75, 2.25, 4.25]
    got, net = fetched({"https://h.org/x": [Response(429, headers={"Retry-After": "30"}), Response(200, PAGE, HTML)]}, ["https://h.org/x"], respect_robots=False)
    assert net.asked[1][0] - net.asked[0][0] >= 30 and got["https://h.org/x"][4] is None
    got, _ = fetched({"https://h.org/x": Response(500), "https://h.org/y": Response(404), "https://h.org/z": OSError("no route")}, ["https://h.org/x", "https://h.org/y", "https://h.org/z"], respect_robots=False)
    assert [g[4:] for g in got.values()] == [("http 500", 4), ("http 404", 1), ("no answer: no route", 4)]


def test_robots_are_asked_once_and_heeded():
    answers = {"https://h.org/robots.txt": Response(200, b"User-agent: *\nDisallow: /private/"), "https://h.org/a": Response(200, PAGE, HTML), "https://h.org/private/b": Response(200, PAGE, HTML), "https://e.org/robots.txt": Response(500), "https://e.org/a": Response(200, PAGE, HTML)}
    got, net = fetched(answers, ["https://h.org/a", "https://h.org/private/b", "https://e.org/a", "ftp://h.org/c", ""])
    assert {u: g[4] for u, g in got.items()} == {"https://h.org/a": None, "https://h.org/private/b": "robots", "https://e.org/a": None, "ftp://h.org/c": "not an address", "": "not an address"}
    assert not any("private" in u for _, u, *_ in net.asked)


@pytest.mark.parametrize(
    ("body", "kind", "text"),
    [
        ("时间".encode(), "text/html", "时间"), ("时间".encode("gb18030"), "text/html; charset=ISO-8859-1", "时间"), ("é".encode("cp1252"), "text/html; charset=windows-1252", "é"), (b"\xef\xbb\xbfx", "", "x"),
        ('<meta charset="big5">時間'.encode("big5"), "text/html", '<meta charset="big5">時間'), ('<?xml version="1.0" encoding="gb2312"?>镕'.encode("gbk"), "text/xml", '<?xml version="1.0" encoding="gb2312"?>镕'),
        (b"x", "text/html; charset=none-such", "x"), (b"\xff\xfea\x00", "", "a"), (b"\x81", "", "\x81"),
    ],
)
def test_charsets(body, kind, text):
    assert fetching.decoded(body, kind) == text


def test_pages_that_are_none(spark):
    answers = {
        "https://h.org/ok": (200, PAGE, "text/html"), "https://h.org/gone": (200, b"<h1>404 Not Found</h1>", "text/html"), "https://h.org/cn": (200, "<p>页面不存在</p>".encode(), "text/html"),
        "https://h.org/pdf": (200, b"%PDF", "application/pdf"), "https://h.org/blank": (200, b" \n", "text/html"), "https://h.org/wall": (200, b"Verify you are human. Cloudflare", "text/html"),
    }

    def get(url, headers, auth):
        status, body, kind = answers.get(url, (404, b"", ""))
        return Response(status, body, {"content-type": kind}, url)

    urls = spark.createDataFrame([(u,) for u in [*answers, "https://h.org/ok", None]], "url string")
    got = {r["url"]: (r["error"], r["html"]) for r in fetching.fetch(urls, get, delay=0.0).collect()}
    assert got == {"https://h.org/ok": (None, PAGE.decode()), "https://h.org/gone": ("soft 404", None), "https://h.org/cn": ("soft 404", None), "https://h.org/pdf": ("not a page", None), "https://h.org/blank": ("empty", None), "https://h.org/wall": ("access challenge", None)}
    with pytest.raises(Exception, match="required"):
        fetching.fetch(urls, get, delay=0.0, required=True).collect()


def test_browser_agents():
    clock = Clock()
    net = Net(clock, {"https://news.sciencenet.cn/x": Response(200, PAGE, HTML)})
    Fetcher(net, clock).one(Host(), "https://news.sciencenet.cn/x", browser=True)
    assert {a for _, _, a, _ in net.asked} == {fetching.BROWSER}


GOOD = '<item><title>T{0}</title><link>https://h/{0}</link><description>text {0}</description><pubDate>Fri, 05 Jan 2024</pubDate></item>'


@pytest.mark.parametrize(
    ("feed", "found"),
    [
        (f"<rss><channel>{GOOD.format(1)}<item><title>A &nbsp; b &ouml; c</title><link>https://h/2</link></item>{GOOD.format(3)}</channel></rss>", ["T1", "A b ö c", "T3"]),
        (f"<rss>{GOOD.format(1)}<item><title>No end<link>https://h/2</link><category>x<description>open {GOOD.format(3)}", ["T1", "No end", "T3"]),
        (f"<rss>{GOOD.format(1)}<item><title>Cut</title><link>https://h/2</link><description><![CDATA[a <b>text</b> that breaks off", ["T1", "Cut"]),
        (f"<rss>{GOOD.format(1)}<item><title>Raw</title><link>https://h/2</link><description><p>one<br>two & three</description></item>{GOOD.format(3)}", ["T1", "Raw", "T3"]),
        ('<feed><entry><title>E</title><link rel="edit" href="/e"/><link href="https://h/1"/><source><title>S</title><link href="/s"/></source><updated>2024-01-05</updated>&oops;</entry></feed>', ["E"]),
        ("no feed at all", []), ("<rss><item><title>x</title></item>&", []), ("", []), ("<item><link>u", [""]), ("<a" * 2000, []),
    ],
)
def test_feeds_with_faults(feed, found):
    assert [e[0] for e in feeds.parse_feed(feed)] == found


def test_entries_of_feeds():
    text = f"<rss><item><title>Raw</title><link>https://h/2</link><description><p>one<br>two &amp; three</description><content:encoded>short</content:encoded></item>{GOOD.format(3)}"
    assert feeds.parse_feed(text) == [("Raw", "https://h/2", "", "one two & three", False), ("T3", "https://h/3", "Fri, 05 Jan 2024", "text 3", False)]
    whole = "<rss><channel>" + "".join(GOOD.format(k) for k in range(5)) + "</channel></rss>"
    assert feeds.well_formed(whole) == feeds.recovered(whole) and len(feeds.parse_feed(whole, 2)) == 2
    assert feeds.parse_feed('<?xml version="1.0" encoding="gb2312"?><rss><channel><item><title>时间</title><link>u</link></item></channel></rss>')[0][0] == "时间"


def test_feeds_are_fetched(spark):
    body = ("<rss><channel>" + "".join(GOOD.format(k) for k in range(5)) + "</channel></rss>").encode()

    def get(url, headers, auth):
        if url == "https://a.org/feed" or url == "https://b.org/private" and auth == ("me", "pw"):
            return Response(200, body, {"content-type": "application/rss+xml"})
        return Response(404)

    schema = "name string, feed_url string, user string, secret string, required boolean"
    rows = [("a", "https://a.org/feed", None, None, False), ("b", "https://b.org/private", "me", "pw", True), ("c", "https://c.org/none", None, None, False), ("d", "", None, None, True)]
    got = {}
    for r in feeds.fetch_entries(spark.createDataFrame(rows, schema), get, limit=3, delay=0.0).collect():
        got.setdefault(r["name"], []).append(r["title"])
    assert got == {"a": ["T0", "T1", "T2"], "b": ["T0", "T1", "T2"]}
    with pytest.raises(Exception, match="feed of b"):
        feeds.fetch_entries(spark.createDataFrame([("b", "https://b.org/private", "me", "", True)], schema), get, delay=0.0).collect()
    tried = [("a", 1, "u1", None), ("a", 2, "u2", "<html>no feed</html>"), ("a", 3, "u3", body.decode()), ("a", 4, "u4", body.decode()), ("b", 1, "v", "")]
    found = feeds.first_feeds(spark.createDataFrame(tried, "name string, rank int, url string, body string")).collect()
    assert {(r["name"], r["feed_url"]) for r in found} == {("a", "u3")} and len(found) == 5


def test_a_feed_that_holds_a_link_twice(spark):
    pages = spark.createDataFrame([("u", "", "", "", "unknown", "")], "url string, title string, published_at string, content string, content_status string, content_extraction string")
    feed = spark.createDataFrame([("u", "one", "", "short", False), ("u", "two", "", "a longer text", False), ("u", "two", "", "a longer text", False)], "url string, title string, published_at string, summary string, content_is_full boolean")
    assert [(r["title"], r["content"]) for r in feeds.merge_pages(pages, feed).collect()] == [("two", "a longer text")]


DATES = {
    "2024-01-05": "2024-01-05", "2024-01-05T23:30:00+00:00": "2024-01-06", "2024-01-05T23:30:00Z": "2024-01-06", "2024-01-05 23:30": "2024-01-05", "2024年1月5日 10时30分": "2024-01-05", "2024/1/5": "2024-01-05",
    "Fri, 05 Jan 2024 10:00:00 GMT": "2024-01-05", "Fri, 05 Jan 2024 20:00:00 EST": "2024-01-06", "Friday, January 5, 2024": "2024-01-05", "Jan. 5th, 2024": "2024-01-05", "5 January 2024": "2024-01-05", "5th of January 2024": "2024-01-05",
    "Published: January 5, 2024 by A. Writer": "2024-01-05", "Posted on 5 Sept 2024 at 3:15 pm": "2024-09-05", "Updated 01/05/2024 11:30 PM EST": "2024-01-06", "01/05/24": "2024-01-05", "13/05/2024": "2024-05-13", "05/13/2024": "2024-05-13",
    "20240105": "2024-01-05", "20240105103000": "2024-01-05", "Fri Jan  5 10:00:00 2024": "2024-01-05", "5-Jan-99": "1999-01-05", "5-Jan-24": "2024-01-05", "2024.01.05": "2024-01-05", "发布时间：2024-01-05 08:00 来源：新华网": "2024-01-05",
    "Jan 5, 2024 | 4 min read": "2024-01-05", "4 min read Jan 5, 2024": "2024-01-05", "Edition 12, 5 Jan 2024": "2024-01-05", "2024-01-05 00:30:00 +0900": "2024-01-04", "12:30 AM, Jan 5, 2024": "2024-01-05",
    "": None, "soon": None, "January 2024": None, "2024": None, "5 minutes ago": None, "31/02/2024": None, "99/99/9999": None, "10:30": None, "1 2 3 4 5": None, "v1.2.3": None, "12345678901234567890": None, "May I have a word": None,
}


@pytest.mark.parametrize(("text", "day"), DATES.items())
def test_dates_in_free_text(text, day):
    assert read(text) == day


def test_dates_of_columns(spark):
    assert read("05/01/2024", day_first=True) == "2024-01-05" and read(None) is None and read("1/2/2024 " * 10_000) == "2024-01-02"
    rows = spark.createDataFrame([("Jan 5, 2024",), (None,), ("soon",)], "t string")
    assert [r[0] for r in rows.select(free_date(rows["t"])).collect()] == [dt.date(2024, 1, 5), None, None]


def test_every_spelling_of_every_day():
    spellings = ["%Y-%m-%d", "%d %B %Y", "%B %d, %Y", "%b %d %Y", "%a, %d %b %Y", "%A %d %b. %Y", "%m/%d/%Y", "%Y/%m/%d", "%Y%m%d", "%d-%b-%y", "%b-%d-%Y", "on %A, %B %d of %Y"]
    for k in range(0, 3000, 7):
        day = dt.date(2019, 1, 1) + dt.timedelta(k)
        for s in spellings:
            assert read(day.strftime(s)) == day.isoformat(), (s, day)
