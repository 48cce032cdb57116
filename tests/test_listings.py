"""Selectors, saved listing pages of the channels, reading page after page, and full texts."""

import datetime as dt
import itertools
import time

import pytest
from pyspark.sql import functions as F

from newsloom.functions import extract, html, selectors
from newsloom.sources import channels, listings

BATTERIES = """<h2>Our stories</h2><div class="gridlove-module x"><h3>Latest stories</h3>
<article class="gridlove-post"><h2 class="entry-title"><a href="/a/">First of them</a></h2><div class="meta-date"><span class="updated">January 5, 2024</span></div></article>
<article class="gridlove-post"><h2 class="entry-title"><a href="https://www.batteriesnews.com/b/#x">Second</a></h2><div class="meta-date"><span class="updated">soon</span></div></article>
<article class="gridlove-post"><h2 class="entry-title"><a href="/a/#again">First again</a></h2></article><article class="gridlove-post"><h2 class="entry-title"><a href="https://other.org/c/">Elsewhere</a></h2></article>
</div><article class="gridlove-post"><h2 class="entry-title"><a href="/outside/">Outside</a></h2></article><a href="#">Load more</a><a href="/page/2/#now">LOAD  MORE</a>"""
DATA_CENTERS = """<a class="ListPreview-Title" href="/before">no</a><div class="ListContent"><div class="ListContent-Content_latest"><div class="y ContentPreview-x"><a class="ContentCard-Title" href="/late">Late</a><i class="ContentCard-Date">Jan 4, 2024</i></div></div>
<div class="ListContent-Content_featured"><div class="ContentPreview"><i class="ArticlePreview-Date">Jan 5, 2024</i><a class="ArticlePreview-Title" href="/featured">Featured</a></div><a class="ArticlePreview-Title" href="/bare">Bare</a></div>
<div class="ListContent-ContentItem"><div class="ContentPreview"><a class="ListPreview-Title" href="/late">Late once more</a><i class="ListPreview-Date">Jan 3, 2024</i></div></div>
<nav class="ListContent-Pagination"><a aria-label="Go to Next page 2" href="?page=2">2</a></nav></div>"""
ENGINEERING = """<article><h1>News</h1><section><div>not a day</div><div>January 5, 2024</div><h3><a href="/energy/one">One</a></h3><div><section><h3><a href="/nested">Nested</a></h3></section></div></section>
<section><div>January 4, 2024</div><h3><a href="/news/page/2">Page</a></h3><h3><a href="/space/two">Two</a></h3></section></article><section><div>January 1, 2024</div><h3><a href="/no">No</a></h3></section><a aria-label="Go to next page" href="/news/page/2">next</a>"""


def cards(name, base, page):
    found, following = listings.page_cards(html.parse(page), channels.channel(name).cards, base)
    return [(link.rpartition("/")[2] or link, title, dates) for link, title, dates in found], following


def test_cards_of_saved_pages():
    got, following = cards(" Batteries News ", "https://batteriesnews.com/", BATTERIES)
    assert [g[1:] for g in got] == [("First of them", ["January 5, 2024"]), ("Second", ["soon"])] and following == "https://batteriesnews.com/page/2/"
    got, following = cards("Data Center Knowledge", "https://www.datacenterknowledge.com/latest-news", DATA_CENTERS)
    assert got == [("featured", "Featured", ["Jan 5, 2024"]), ("bare", "Bare", []), ("late", "Late", ["Jan 4, 2024"])]
    assert following == "https://www.datacenterknowledge.com/latest-news?page=2"
    got, following = cards("Interesting Engineering", "https://interestingengineering.com/news", ENGINEERING)
    assert got == [("one", "One", ["not a day", "January 5, 2024", "Nested"]), ("nested", "Nested", ["not a day", "January 5, 2024", "Nested"]), ("two", "Two", ["January 4, 2024"])]
    assert following == "https://interestingengineering.com/news/page/2"
    assert cards("batteries news", "https://batteriesnews.com/", "<p>nothing</p>") == ([], "") and cards("data center knowledge", "https://x.org", "") == ([], "")


def test_read_listings_gives_dates_and_next_pages(spark):
    rows = [("Batteries News", "https://batteriesnews.com/", 0, BATTERIES), ("Interesting Engineering", "https://interestingengineering.com/news", 0, ENGINEERING), ("x", None, 0, None), ("y", "https://[half", 0, "<a href='//[x'>A title that is long</a>")]
    found = listings.read_listings(spark.createDataFrame(rows, "name string, page_url string, page_no int, html string"))
    dated = {r["title"]: str(r["published_date"]) for r in listings.dated_cards(found).collect()}
    assert dated == {"First of them": "2024-01-05", "Second": "None", "One": "2024-01-05", "Nested": "2024-01-05", "Two": "2024-01-04"}
    assert sorted(r["next_url"] for r in found.where("next_url IS NOT NULL").collect()) == ["https://batteriesnews.com/page/2/", "https://interestingengineering.com/news/page/2"]


#: A link that each channel takes, one that its selectors find but its path, query or site does not allow, and one that they do not find.
LINKS = {
    "光伏测试网": ("https://www.testpv.com/", '<a class="xi2" href="portal.php?mod=view&amp;aid=12">A long enough title</a><a class="xi2" href="portal.php?mod=view">Without a number</a><a href="portal.php?mod=view&amp;aid=13">Not of the class</a>', ["https://www.testpv.com/portal.php?mod=view&aid=12"]),
    "索比光伏": ("https://news.solarbe.com/", '<div class="recommend-content-right"><a class="title2" href="/202401/05/123.html">t</a><a href="/202401/05/124.html">t</a></div><p class="Select-recommend-item"><a href="/about">A long enough title</a></p>', ["https://news.solarbe.com/202401/05/123.html"]),
    "北极星储能网": ("https://chuneng.bjx.com.cn/", '<a href="https://news.bjx.com.cn/html/20240105/1.shtml">标题</a><a href="https://news.bjx.com.cn/html/x.shtml">Another title here</a>', ["https://news.bjx.com.cn/html/20240105/1.shtml"]),
    "insideevs": ("https://insideevs.com/news/", '<article><h3><a href="/news/7/a-b/">A title of some length</a></h3></article><a href="/reviews/8/c/">Another title here</a>', ["https://insideevs.com/news/7/a-b/"]),
    "ne时代": ("https://ne-time.cn/web/", '<a class="article-item" href="/web/article/5">T</a><a href="/web/article/6">T</a>', ["https://ne-time.cn/web/article/5"]),
    "volta foundation": ("https://volta.foundation/battery-news", '<main><a href="/one-story">A title of some length</a><a href="/battery-news/">All of the news</a><a href="/a/b">A title too deep down</a><a href="https://shop.volta.foundation/x">A shop of the foundation</a></main>', ["https://volta.foundation/one-story", "https://shop.volta.foundation/x"]),
    "battery tech online": ("https://www.batterytechonline.com/battery-news", '<div class="card"><a href="/ev-batteries/a-story">A title of some length</a><a href="/battery-news/battery-breaking-news-headlines">All of the headlines</a><a href="/else/where">A title of some length</a></div>', ["https://www.batterytechonline.com/ev-batteries/a-story"]),
    "renewables now": ("https://renewablesnow.com/", '<a href="/news/archive">Archive of the news</a><a href="/news/wind-farm-sold-123/">x</a><a href="/wind/">The wind sector</a>', ["https://renewablesnow.com/news/wind-farm-sold-123/"]),
    "4c offshore": ("https://www.4coffshore.com/news/", '<a href="/news/a-nid123.html">A wind farm</a><a href="/news/b.html">Another wind farm</a>', ["https://www.4coffshore.com/news/a-nid123.html"]),
    "科学网新闻": ("https://news.sciencenet.cn/", '<a href="/htmlnews/2024/1/5.shtm">x</a><a href="/htmlnews/all.shtm">All of the news</a>', ["https://news.sciencenet.cn/htmlnews/2024/1/5.shtm"]),
    "新华网科技": ("http://www.news.cn/tech/", '<div class="focus"><b class="tit"><a href="/tech/20240105/abc/c.html">Focus</a></b></div><div id="content-list"><p class="item"><b class="tit"><a href="/tech/20240106/def/c.html">Listed</a></b></p></div>', ["http://www.news.cn/tech/20240106/def/c.html", "http://www.news.cn/tech/20240105/abc/c.html"]),
    "pv magazine c&i pv": ("https://www.pv-magazine.com/latest-news/", '<div class="pvmagazine-article-feed"><div class="pvmagazine-article-feed__inner"><p class="post-block"><a class="post-block__title" href="/2024/01/05/x/">X</a></p></div><a class="post-block__title" href="/2024/01/05/y/">Y</a></div>', ["https://www.pv-magazine.com/2024/01/05/x/"]),
    "perovskite-info": ("https://www.perovskite-info.com/", '<article class="node--type-story"><a rel="bookmark" href="/one">A title of some length</a></article><article><a rel="bookmark" href="/two">A title of some length</a></article>', ["https://www.perovskite-info.com/one"]),
    "electrek": ("https://electrek.co/", '<h2 class="entry-title"><a href="/story/one">A title of some length</a></h2><a href="/story/two">A title of some length</a>', ["https://electrek.co/story/one"]),
    "any other": ("https://h.org/", '<a href="/plain">A title of some length</a><ul><li><a href="/2024/05/x.html">x</a></li></ul><a href="/y">short</a><script>"https:\\/\\/h.org\\/2024\\/01\\/05\\/77\\/a-story"</script>', ["https://h.org/2024/05/x.html", "https://h.org/2024/01/05/77/a-story", "https://h.org/plain"]),
}


def test_links_of_every_kind_of_channel(spark):
    rows = [(name, base, 0, page) for name, (base, page, _) in LINKS.items()]
    links = listings.article_links(listings.read_listings(spark.createDataFrame(rows, "name string, page_url string, page_no int, html string")), spark)
    got = {}
    for r in sorted(links.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["name"], []).append(r["link"])
    assert got == {name: want for name, (_, _, want) in LINKS.items()}


def test_channels_and_their_pages(spark):
    assert len(channels.CHANNELS) == 32 and all(name == channels.key(name) for name in channels.CHANNELS)
    for c in channels.CHANNELS.values():
        assert c.cards or selectors.compiled(*c.selectors)
    sources = spark.createDataFrame([("H2 View", "https://h2/"), ("科学网新闻", "https://news.sciencenet.cn/x"), ("PV Magazine C&I PV", "https://pv/"), ("any", "https://h.org/")], "name string, url string")
    pages = {}
    for r in listings.listing_pages(sources, spark).orderBy("name", "page_no").collect():
        pages.setdefault(r["name"], []).append(r["page_url"])
    assert pages == {"H2 View": ["https://www.gasworld.com/h2-view/latest-news/", "https://h2/"], "科学网新闻": ["https://news.sciencenet.cn/x", "https://news.sciencenet.cn/todaynews.aspx", "https://news.sciencenet.cn/"], "PV Magazine C&I PV": ["https://www.pv-magazine.com/latest-news/"], "any": ["https://h.org/"]}
    entries = spark.createDataFrame([("EnergyTrend储能", "https://e/news/20240105-1.html"), ("EnergyTrend储能", "https://e/price/1.html"), ("any", "https://h.org/price/1")], "name string, url string")
    assert sorted(r["url"] for r in listings.accepted_entries(entries, spark).collect()) == ["https://e/news/20240105-1.html", "https://h.org/price/1"]


def test_all_channels_page_after_page(spark, tmp_path):
    def page(days, following):
        posts = "".join(f'<article class="gridlove-post"><h2 class="entry-title"><a href="/{d}-{k}/">T</a></h2><b class="meta-date"><i class="updated">2024-01-{d:02}</i></b></article>' for k, d in enumerate(days))
        return f'<div class="gridlove-module"><h3>Latest</h3>{posts}</div>' + (f'<a href="{following}">load more</a>' if following else "")

    stored = {"https://b.org/": page([9, 8], "/2"), "https://b.org/2": page([8, 7], "/3"), "https://b.org/3": page([3, 2], "/4"), "https://b.org/4": page([1], ""), "https://h.org/": '<a href="/2024/05/x.html">x</a>'}
    asked = []

    def read(todo):
        rows = [(r["name"], r["page_url"], r["page_no"], stored.get(r["page_url"])) for r in todo.collect()]
        asked.append(sorted(r[1] for r in rows))
        return spark.createDataFrame(rows, "name string, page_url string, page_no int, html string")

    sources = spark.createDataFrame([("Batteries News", "https://b.org/"), ("any", "https://h.org/")], "name string, url string")
    folder = listings.crawl(spark, sources, read, str(tmp_path), day=F.lit("2024-01-08").cast("date"))
    assert asked == [["https://b.org/", "https://h.org/"], ["https://b.org/2"], ["https://b.org/3"]]  # the 3rd is too old to go on
    found = spark.read.schema(listings.FOUND).parquet(f"{folder}/version=*")
    cards = listings.dated_cards(found)
    assert sorted((r["page_no"], r["pos"]) for r in cards.where("published_date = '2024-01-08'").collect()) == [(0, 1), (1, 0)]
    asked.clear()
    listings.crawl(spark, sources, read, str(tmp_path / "few"), limit=3)
    assert asked == [["https://b.org/", "https://h.org/"], ["https://b.org/2"]]


def test_readers_give_up(spark):
    day = dt.date(2024, 1, 8)
    rows = [("a", r, False, day) for r in (1, 2)] + [("a", r, r == 7, None if r == 7 else day - dt.timedelta(1)) for r in range(3, 14)] + [("a", 14, False, day)]
    rows += [("b", r, True, None) for r in range(1, 10)] + [("b", 10, False, day), ("b", 11, False, day)] + [("b", r, True, None) for r in range(12, 22)] + [("b", 22, False, day)]
    rows += [("c", r, False, day) for r in range(1, 9)] + [("d", r, False, day - dt.timedelta(r % 5 > 0)) for r in range(1, 30)]
    got = {}
    for r in listings.until_in_a_row(spark.createDataFrame(rows, "name string, rank int, failed boolean, date date"), F.lit(day), 5).orderBy("name", "rank").collect():
        got.setdefault(r["name"], []).append(r["rank"])
    assert got == {"a": [1, 2], "b": [10, 11], "c": [1, 2, 3, 4, 5], "d": [5, 10, 15, 20, 25]}


@pytest.mark.parametrize(
    ("selector", "found"),
    [
        ("div a", ["1", "2", "3"]), ("div > a", ["1", "3"]), ("div > p > a", ["2"]), ("body > a", []), ("a[href]", ["1", "2"]), ("a[href='/x']", ["1"]), ("a[href^='/']", ["1"]), ('a[href$=".html"]', ["2"]),
        ("a[href*='h.org']", ["2"]), ("a[href*='']", []), (".k.l a", ["1", "2", "3"]), ("[class*='m'] a", ["2"]), ("div#d > p.m.n a.z", ["2"]), ("*", None), ("p a.z", ["2"]), ("div div a", []), ("A.Z", []), ("a[class~='z']", ["2"]),
    ],
)
def test_selectors_find(selector, found):
    root = html.parse('<body><div id="d" class="k l"><a id="1" href="/x">a</a><p class="m n"><a id="2" class="z y" href="https://h.org/a.html">b</a></p><a id="3">c</a></div></body>')
    got = [n.attrs.get("id") for n in selectors.select(root, selector)]
    assert got == found if found is not None else len(got) == 7


def test_selectors_that_are_none():
    for bad in ("", "> a", "a >", "a[", "a:first-child", "a, b"):
        with pytest.raises(ValueError, match="not a selector"):
            selectors.steps(bad)


def slow_select(root, selector):
    """Elements that a selector finds, by looking upwards from each."""
    want = selectors.steps(selector)

    def fits(node, k):
        if not want[k][1].meets(node, node.attrs.get("class", "").split()):
            return False
        if k == 0:
            return True
        up = node.parent
        if want[k][0]:
            return bool(up) and fits(up, k - 1)
        while up:
            if fits(up, k - 1):
                return True
            up = up.parent
        return False

    return [n for n in root.walk() if fits(n, len(want) - 1)]


def test_one_pass_finds_what_looking_upwards_finds():
    import random

    rng = random.Random(5)
    tags, classes = ["div", "p", "b"], ["x", "y"]

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else ""
        tag = rng.choice(tags[0::2]) if depth else "p"
        return f'<{tag} class="{" ".join(rng.sample(classes, rng.randrange(3)))}">{inner}</{tag}>'

    root = html.parse("".join(tree(6) for _ in range(6)))
    parts = [*tags, ".x", ".y", "div.x", "*"]
    wanted = [a + sep + b + more for a in parts for sep in (" ", " > ") for b in parts for more in ("", " > .x", " b")]
    got = {}
    for place, node in selectors.compiled(*wanted).run(root):
        got.setdefault(place, []).append(node)
    assert all([id(n) for n in got.get(i, [])] == [id(n) for n in slow_select(root, s)] for i, s in enumerate(wanted))


def test_stretches_of_lines_are_worth_most():
    for size in range(8):
        for worth in itertools.product((-100, -30, 50, 90), repeat=size) if size < 6 else [(50, -30, -30, 90, -100, 70, 10)[:size]]:
            kept = extract.split(list(worth))
            value = lambda flags: sum(w for w, k in zip(worth, flags, strict=True) if k) - extract.CHANGE * sum(k and not (i and flags[i - 1]) for i, k in enumerate(flags))  # noqa: B023, E731
            assert value(kept) == max(map(value, itertools.product((False, True), repeat=size)))


def old_scores(root):
    """Score of every element that may be a body, each from its own walk."""
    noise = frozenset(extract.NOISE)
    for n in root.walk(noise):
        if n.tag in extract.BODIES:
            blocks = extract.block_texts(n)
            text = "\n".join(dict.fromkeys(blocks)) or n.text(noise)
            links = sum(len(a.text()) for a in n.walk(noise) if a.tag == "a")
            yield len(text) + 120 * len(blocks) - 2 * min(links, len(text)) + (n.tag == "article"), text


def test_bottom_up_scores_are_those_of_single_walks():
    import random

    rng = random.Random(7)
    words = ["one ", " two", "three", "\n", "", "  four  words here "]

    def tree(depth):
        if not depth:
            return rng.choice(words)
        tag = rng.choice(["div", "section", "article", "p", "li", "a", "nav", "span", "main", "td"])
        return f"<{tag}>" + "".join(tree(depth - 1 - rng.randrange(depth)) for _ in range(rng.randrange(5))) + f"</{tag}>" + rng.choice(words)

    for _ in range(150):
        root = html.parse("".join(tree(5) for _ in range(3)))
        scores = list(old_scores(root))
        best = max((s for s, _ in scores), default=0)
        want = next((t for s, t in scores if s == best), "") if best > 0 else ""
        assert extract.best_block(root) == want


def test_time_grows_with_the_page_alone():
    took = []
    for n in (2500, 10_000):
        page = "<article>" + "<div><p>A paragraph of this block.</p>" * n + "</div>" * n + "</article>" + "</b>" * n
        began = time.perf_counter()
        root = html.parse(page)
        assert len(extract.best_block(root)) == 26 and extract.full_text(root).count("\n") in (0, n - 1)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0]  # four times the page; sixteen times would be quadratic


def test_full_text_goes_before_a_shorter_element(spark):
    page = "<title>T</title><div><p>{0}</p></div><section>{0} And what stands beside it, without an element of its own.<br>{0}</section><ul><li><a href='/x'>Menu</a></li><li><a href='/y'>More</a></li></ul>".format("A long line of the text of this page, which goes on.")
    row = html.page_articles(spark.createDataFrame([("https://h.org/a", page, "x")], "url string, html string, source_name string")).first()
    assert row["content_extraction"] == html.FULL_TEXT and row["content"].count("A long line") == 3 and "Menu" not in row["content"]
