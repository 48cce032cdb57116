import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.functions import channels, dates, html, text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("content", "method", "expected"),
    [
        (None, "", ("missing", "empty_content")),
        (" 　\n", "dom", ("missing", "empty_content")),
        ("Please VERIFY you are human. Cloudflare", "dom", ("missing", "access_challenge")),
        ("text. Sign in to continue", "dom", ("incomplete", "paywall_or_login_wall")),
        ("text goes on… ", "dom", ("incomplete", "truncated_ending")),
        ("text", "rss_excerpt", ("incomplete", "rss_excerpt_only")),
        ("text", "public_preview", ("incomplete", "public_preview_only")),
        ("text", "dom", ("full", "")),
        ("text", "", ("unknown", "legacy_record_not_verified")),
    ],
)
def test_assess(spark, content, method, expected):
    got = one(spark, text.assess(F.lit(content).cast("string"), F.lit(method)))
    assert (got["status"], got["issue"]) == expected


URLS = [
    "http://www.example.com/a/?utm_source=x&b=2", "https://example.com/a?b=2", "https://Example.com:443/x//", "http://h:8080/p?z=1&a=&a=0&FBCLID=9#f", "no-host/", "", None, "https://h/%E4?q=a%7Cb", "ftp://h/x", "https://h?x",
]


def test_url_keys(spark):
    assert urls.url_key(URLS[0]) == urls.url_key(URLS[1]) == "https://example.com/a?b=2"
    rows = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", urls.canonical_url("url").alias("exact"), urls.address_key(F.col("url")).alias("key"), urls.canonical_url_native(F.col("url")).alias("native")).collect()
    for r in rows:
        assert r["exact"] == r["key"] == urls.url_key(r["url"])
        assert r["native"] in (None, r["exact"]), r


@pytest.mark.parametrize(
    ("url", "expected"),
    [("https://a/t20240105_1.html", dt.date(2024, 1, 5)), ("https://a/2024/2/30/x", None), ("https://a/202401/7abc.html", dt.date(2024, 1, 7)), ("https://a/x-2024-3-9", dt.date(2024, 3, 9)), ("https://a/20241301/2024-01-01", None), (None, None)],
)
def test_url_date(spark, url, expected):
    assert one(spark, dates.url_date(F.lit(url).cast("string"))) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2024-01-05", dt.date(2024, 1, 5)), ("2024年1月5日 23:10", dt.date(2024, 1, 5)), ("2024-01-05T23:30:00+00:00", dt.date(2024, 1, 6)), ("Fri, 05 Jan 2024 20:00:00 EST", dt.date(2024, 1, 6)),
        ("2024-01-05T20:00:00Z", dt.date(2024, 1, 6)), ("January 5, 2024", dt.date(2024, 1, 5)), ("1/5/2024", dt.date(2024, 1, 5)), ("", None), ("soon", None), (None, None),
    ],
)
def test_published_date(spark, value, expected):
    assert one(spark, dates.published_date(F.lit(value).cast("string"))) == expected


def test_day_first(spark):
    assert one(spark, dates.published_date(F.lit("5/1/2024"), F.lit(True))) == dt.date(2024, 1, 5)


def test_target_dates():
    assert dates.default_target_date(dt.datetime(2026, 7, 14, 0, 30)) == dt.date(2026, 7, 12)
    assert dates.default_target_date(dt.datetime(2026, 7, 14, 7, 0)) == dt.date(2026, 7, 13)
    assert dates.parse_target_date("2024-02-29", dt.datetime(2024, 3, 1)) == dt.date(2024, 2, 29)
    assert dates.previous_period(dt.date(2024, 3, 6), "week") == (dt.date(2024, 2, 26), dt.date(2024, 3, 3))
    assert dates.previous_period(dt.date(2024, 3, 6), "month") == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


@pytest.mark.parametrize(("frequency", "day", "expected"), [("每日", "2024-01-06", True), ("工作日", "2024-01-06", False), ("工作日", "2024-01-05", True), ("实时（新闻资讯）+季度（新闻整合）", "2024-01-05", False), (None, "2024-01-05", True)])
def test_expects(spark, frequency, day, expected):
    assert one(spark, channels.expects_on(F.lit(frequency).cast("string"), F.lit(day).cast("date"))) is expected


@pytest.mark.parametrize(("reason", "expected"), [("Read timed out", "timeout"), ("missing run record: x", "missing_run_record"), ("HTTP 401", "authentication_failed"), ("odd", "fetch_failed"), (None, "fetch_failed")])
def test_diagnosis(spark, reason, expected):
    assert one(spark, channels.diagnosis(F.lit("failed"), F.lit(reason).cast("string"), F.lit(0), F.lit(0))) == expected


def test_text_helpers(spark):
    assert one(spark, text.redact(F.lit("API_KEY=abc&x=1 password: p, z"))) == "API_KEY=[REDACTED]&x=1 password: [REDACTED], z"
    assert one(spark, text.clip(F.lit("a" * 700), 600)) == "a" * 432 + "\n……[正文截断]……\n" + "a" * 156
    assert one(spark, text.title_key(F.lit("  A\tB  c "))) == "a b c"
    assert one(spark, text.body_lines(F.lit("short\nmail me at a@b.org today\nwww.example.com\na line that stays\n2024-01-05 10:00"))) == ["a line that stays"]
    assert one(spark, urls.registrable_site(F.lit("www.a.b.com.cn:80"))) == "b.com.cn"
    assert one(spark, urls.feed_url(F.lit("RSS：https://a/feed；x"))) == "https://a/feed"


PAGE = """<html><head><title>Page</title><meta property="og:title" content="Head &amp; line"><link rel="canonical" href="/c">
<script type="application/ld+json">{"@graph": [{"datePublished": "2024-01-05", "articleBody": "short"}]}</script></head>
<body><nav><a href="/n">nav</a></nav><article><p>First part of the body.</p><p>Second part, with a <a href="/l#f">link</a>.</p></article><footer>foot</footer></body></html>"""


def test_html(spark):
    root = html.parse(PAGE)
    assert html.title(root) == "Head & line"
    assert html.published(root) == "2024-01-05"
    assert html.body(root)[0] == "First part of the body.\nSecond part, with a link."
    rows = html.articles(spark.createDataFrame([(1, PAGE), (2, ""), (3, None)], "id int, html string")).collect()
    assert [(r["id"], r["declared_url"]) for r in rows] == [(1, "/c")]
    found = html.listing(spark.createDataFrame([("https://h/x", PAGE)], "url string, html string")).collect()
    assert [r["link"] for r in found] == ["https://h/n", "https://h/l"]
    assert urls.resolve_canonical("https://h/2024/01/05/a", "https://h/2024/01/06/a", lambda u: u[10:20]) == "https://h/2024/01/05/a"
    assert urls.resolve_canonical("https://h/a", "[url]", lambda u: None) == "https://h/a"
