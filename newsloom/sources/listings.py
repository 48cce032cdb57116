"""Listings: links and dated cards of a channel's pages, page after page, with limits.

Pages are read once each by the channel's compiled selectors (``functions.selectors``); what a link is worth, which
cards are of a day and where reading ends are frame operations over all channels at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import free_dates
from newsloom.functions.dates import once, published_date
from newsloom.functions.dom import Node, parse
from newsloom.functions.selectors import compiled, first, select
from newsloom.functions.urls import host, is_article_path, registrable_site, same_site
from newsloom.sources import channels
from newsloom.sources.channels import CHANNELS, Cards, Channel
from newsloom.sources.files import write_version

#: Shortest title of a link that does not look like an article's; most pages of a listing; articles in a
#: row that are older, or cannot be read, before a channel is left; addresses of articles in scripts.
WEAK_TITLE_CHARS, MOST_PAGES, IN_A_ROW = 8, 20, 10
EMBEDDED = re.compile(r"(?i)(?:(?:https?:)?//[^\"'<> ]+)?/20\d{2}/\d{1,2}/\d{1,2}/\d+/[a-z0-9-]+(?:/amp)?/?")
#: Place of a link that no selector has found but a script, and of a dated card.
IN_SCRIPT, CARD = 10_000, -1

FOUND = "name string, page_url string, page_no int, selector int, pos int, link string, title string, dates array<string>, next_url string"


def rules(spark: SparkSession) -> DataFrame:
    """The channel rules that frames need, as a table of one row a channel."""
    rows = [(name, c.path, c.query, c.site, list(c.not_paths), c.factor, list(c.listings), c.own, c.own_first, c.pages, c.workbook, c.feed_path, c.cards is not None) for name, c in CHANNELS.items()]
    return spark.createDataFrame(rows, "channel string, path_regex string, query_regex string, only_site string, not_paths array<string>, factor int, listings array<string>, own boolean, own_first boolean, pages int, workbook string, feed_path string, dated boolean")


def with_rules(rows: DataFrame, spark: SparkSession) -> DataFrame:
    r = F.broadcast(rules(spark))  # as many rows as channels with rules
    return rows.join(r, F.lower(F.trim("name")) == F.col("channel"), "left")


def listing_pages(sources: DataFrame, spark: SparkSession) -> DataFrame:
    """Every page of links of every channel: ``name, page_url, page_no``. A channel's further listings come before its
    own address, unless its rules say otherwise; addresses that begin with a slash are at the channel's host."""
    own = F.when(F.coalesce("own", F.lit(True)), F.array("url")).otherwise(F.array().cast("array<string>"))
    root = F.regexp_extract("url", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    more = F.transform(F.coalesce("listings", F.array().cast("array<string>")), lambda u: F.when(u.startswith("/"), F.concat(root, u)).otherwise(u))
    pages = F.when(F.coalesce("own_first", F.lit(False)), F.concat(own, more)).otherwise(F.concat(more, own))
    return with_rules(sources.select("name", "url"), spark).select("name", F.posexplode(F.array_distinct(pages)).alias("page_no", "page_url"))


def _target(base: str, node: Node) -> str:
    href = node.attrs.get("href", "").strip()
    if not href or href.startswith(("#", "javascript:", "mailto:")):
        return ""
    try:
        target = urldefrag(urljoin(base, href))[0]
        return target if urlsplit(target).scheme in ("http", "https") else ""
    except ValueError:  # an address that is none, such as one with half a bracket
        return ""


def _spaced(node: Node) -> str:
    """The text of an element with a blank between its parts."""
    parts, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            parts.append(n)
        else:
            stack += reversed(n.children)
    return re.sub(r"\s+", " ", " ".join(parts)).strip()


def page_links(root: Node, rule: Channel, base: str, html: str) -> Iterator[tuple]:
    """(selector, place, link, title) of a page's links, each with the first selector that finds it."""
    found: dict[str, tuple[int, int, str]] = {}
    for place, (selector, node) in enumerate(compiled(*rule.selectors).run(root)):
        target = _target(base, node)
        if target and target.rstrip("/") != base.rstrip("/"):
            have = found.get(target)
            if have is None or (selector, place) < have[:2]:
                found[target] = (selector, place, _spaced(node))
    if rule.embedded:
        for place, match in enumerate(EMBEDDED.finditer(html.replace("\\/", "/"))):
            found.setdefault(urldefrag(urljoin(base, match[0]))[0], (IN_SCRIPT, place, ""))
    for target, (selector, place, title) in found.items():
        yield selector, place, target, title


def _ancestor(node: Node, wanted: str) -> Node | None:
    """The nearest element around one that has a tag, or a part of whose class holds what stands behind a dot."""
    up = node.parent
    while up and not (any(wanted[1:] in c for c in up.attrs.get("class", "").split()) if wanted.startswith(".") else up.tag == wanted):
        up = up.parent
    return up


def _scope(root: Node, rule: Cards) -> Node | None:
    if rule.root:
        return first(root, rule.root)
    if rule.heading is None:
        return root
    tags, text, whole = rule.heading
    for node in root.walk():
        if node.tag in tags and (_spaced(node).lower() == text if whole else text in _spaced(node).lower()):
            return _ancestor(node, rule.within)
    return None


def page_cards(root: Node, rule: Cards, base: str) -> tuple[list[tuple[str, str, list[str]]], str]:
    """Cards of a page as (link, title, texts that may be its date), and the address of the next page or nothing."""
    scope, out = _scope(root, rule), {}
    own_host = urlsplit(base).netloc.lower().removeprefix("www.")
    for group, link, date in rule.groups if scope else ():
        for element in select(scope, group):
            if rule.dated and element.parent is not scope:
                continue
            section = [_spaced(c) for c in element.children if isinstance(c, Node) and c.tag == "div"] if rule.dated else []
            for node in select(element, link):
                target = _target(base, node)
                if not target or urlsplit(target).netloc.lower().removeprefix("www.") != own_host or target in out:
                    continue
                if rule.not_under and urlsplit(target).path.startswith(rule.not_under):
                    continue
                around = element if rule.card == group else _ancestor(node, rule.card) if rule.card else None
                dated = first(around, date) if around and date else None
                out[target] = (_spaced(node), section or ([_spaced(dated)] if dated else []))
    # without a card around it nothing bounds the next link, as on a page whose cards are all of another group
    within = scope if rule.root else root
    links = select(within, rule.next_) if rule.next_ and within else [n for n in root.walk() if n.tag == "a" and _spaced(n).lower() == rule.next_text] if rule.next_text and scope else []
    following = next((t for t in (_target(base, n) for n in links) if t and t != urldefrag(base)[0]), "")
    return [(t, title, dates) for t, (title, dates) in out.items()], following


def read_listings(pages: DataFrame) -> DataFrame:
    """What the pages ``name, page_url, page_no, html`` hold by the rules of their channel: ``FOUND``.

    A card has ``selector`` -1 and the texts that may be its date, those that are one as yyyy-mm-dd. A page with a next one has a row for that alone,
    with a null link. Pages that are null or empty give nothing; addresses that are none are left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, base, number, html in zip(frame["name"], frame["page_url"], frame["page_no"], frame["html"], strict=True):
                root, rule = parse(html), channels.channel(name)
                if rule.cards:
                    cards, following = page_cards(root, rule.cards, base or "")
                    out += [(name, base, number, CARD, k, link, title, [free_dates.read(d) or d for d in dates], None) for k, (link, title, dates) in enumerate(cards)]
                else:
                    out += [(name, base, number, s, k, link, title, None, None) for s, k, link, title in page_links(root, rule, base or "", html or "")]
                    nodes = select(root, rule.next_) if rule.next_ else []
                    following = next((t for t in (_target(base or "", n) for n in nodes) if t), "")
                if following:
                    out.append((name, base, number, None, None, None, None, None, following))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FOUND.split(", ")]).astype(object)

    return pages.select("name", "page_url", "page_no", "html").mapInPandas(run, FOUND)


def article_links(links: DataFrame, spark: SparkSession, limit: int = 20) -> DataFrame:
    """The links of listing pages that are articles: ``name, link, title, rank`` from 1.

    ``links`` has ``name, page_url, page_no, pos, link, title`` and may have ``selector``. Links lead to the page's own
    site. Links whose path looks like an article's come before links that only have a title of some length; then
    pages, selectors and places decide. A channel with a path of its own keeps of the first ``factor * limit`` those
    that have it (and the query, the site and none of the paths that its rules name). The first place of a link counts.
    """
    if "selector" not in links.columns:
        links = links.withColumn("selector", F.lit(0))
    path = F.regexp_extract("link", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    own = with_rules(links.where("link IS NOT NULL"), spark).withColumn("path", path).where(same_site(host(F.col("link")), host(F.col("page_url"))))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    ruled = ~blank("path_regex")
    looks = is_article_path(F.col("path")) | (F.col("selector") == IN_SCRIPT)
    own = own.where(looks | ruled & (F.col("factor") >= 1000) | ((F.length(F.trim("title")) >= WEAK_TITLE_CHARS) & (path != "") & (path != "/")) | ruled & F.expr("path RLIKE path_regex"))
    place = F.struct((~looks).cast("int").alias("weak"), "page_no", "selector", "pos")
    first_ = own.groupBy("name", "link").agg(F.min_by(F.struct("title", "path", "path_regex", "query_regex", "only_site", "not_paths", "factor"), place).alias("f"), F.min(place).alias("at"))
    order = Window.partitionBy("name").orderBy("at")
    near = first_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit * F.coalesce("f.factor", F.lit(1))).select("name", "link", "at", "f.*")
    query = F.regexp_extract("link", r"\?([^#]*)", 1)
    bare = F.regexp_replace("path", "/+$", "")
    kept = near.where(blank("path_regex") | F.expr("path RLIKE path_regex")).where(blank("query_regex") | F.coalesce(F.rlike(query, F.col("query_regex")), F.lit(False)))
    kept = kept.where(blank("only_site") | (registrable_site(host(F.col("link"))) == F.col("only_site"))).where(~F.coalesce(F.array_contains("not_paths", bare), F.lit(False)))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("name", "link", "title", "rank")


def dated_cards(found: DataFrame) -> DataFrame:
    """Cards with the first of their texts that is a date: ``name, page_no, pos, link, title, published_date``."""
    day = once(F.filter(F.transform("dates", lambda t: published_date(t)), lambda d: d.isNotNull()), lambda ds: F.get(ds, F.lit(0)))
    return found.where(F.col("selector") == CARD).select("name", "page_no", "pos", "link", "title", day.alias("published_date"))


def accepted_entries(entries: DataFrame, spark: SparkSession) -> DataFrame:
    """Feed entries (``name, url``) that their channel takes: all, unless its rules name a path."""
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    rows = with_rules(entries, spark).withColumn("_path", path)
    return rows.where((F.coalesce("feed_path", F.lit("")) == "") | F.expr("_path RLIKE feed_path")).select(*entries.columns)


def until_older(cards: DataFrame, day: Column, limit: int) -> DataFrame:
    """Cards of stored listing pages as a reader would take them: page after page, up to MOST_PAGES, until the first
    page that has nothing of the day or later, and no more than ``limit`` of the day. Needs ``page_no, pos, published_date``."""
    last = cards.groupBy("page_no").agg(F.max(F.col("published_date") >= day).alias("fresh")).where("NOT fresh").agg(F.min("page_no").alias("stop"))
    seen = cards.crossJoin(F.broadcast(last)).where(F.col("page_no") < MOST_PAGES).where(F.col("stop").isNull() | (F.col("page_no") < F.col("stop")))  # one row
    return seen.where(F.col("published_date") == day).orderBy("page_no", "pos").limit(limit)


def until_in_a_row(fetched: DataFrame, day: Column, limit: int, *, by: str = "name", order: str = "rank", in_a_row: int = IN_A_ROW) -> DataFrame:
    """Articles of a day among those that a channel's links give, in order, up to where its reader gives up.

    ``fetched`` has ``name, rank, failed, date``. Reading ends at the tenth older article in a row (failures in between
    do not count, other dates begin anew) or at the tenth failure in a row, and after ``limit`` articles of the day. Runs are
    found by counting what ends them: rows between two ends share a number.
    """
    along = Window.partitionBy(by).orderBy(order)
    older = F.coalesce(F.col("date") < day, F.lit(False)) & ~F.col("failed")
    rows = fetched.withColumn("_older", older.cast("int")).withColumn("_failed", F.col("failed").cast("int"))
    rows = rows.withColumn("_o", F.sum(F.when(~older & ~F.col("failed"), 1).otherwise(0)).over(along)).withColumn("_f", F.sum(F.when(~F.col("failed"), 1).otherwise(0)).over(along))
    run = lambda what, part: F.sum(what).over(Window.partitionBy(by, part).orderBy(order))
    stop = (run("_older", "_o") >= in_a_row) | (run("_failed", "_f") >= in_a_row)
    ends = rows.withColumn("_stop", F.sum(stop.cast("int")).over(along))  # 0 up to the row before the end
    kept = ends.where((F.col("_stop") == 0) & ~F.col("failed") & (F.col("date") == day))
    return kept.withColumn("_n", F.row_number().over(along)).where(F.col("_n") <= limit).select(*fetched.columns)


def crawl(spark: SparkSession, sources: DataFrame, read: Callable[[DataFrame], DataFrame], home: str, *, day: Column | None = None, limit: int = 100, rounds: int = MOST_PAGES) -> str:
    """Reads the listings of all channels at once, a page a channel and round, and returns the folder of what was found.

    ``read`` gives ``name, page_url, page_no, html`` for ``name, page_url, page_no`` (a fetcher, or a join with stored
    pages). Every round is stored below ``home`` before the next begins, so nothing is fetched twice. A channel goes on
    while a page names a next one that it has not seen, its rules allow another page, it has fewer than ``limit`` links
    and, given a day, while the youngest card of the page is no older than the day before.
    """
    todo, folder = listing_pages(sources, spark), f"{home}/listings"
    seen = []
    for number in range(rounds):
        path = write_version(read_listings(read(todo)), folder, f"round{number}")
        found = spark.read.schema(FOUND).parquet(path)
        seen.append(path)
        every = spark.read.schema(FOUND).parquet(*seen)
        after = with_rules(found.where("next_url IS NOT NULL").groupBy("name").agg(F.min_by("next_url", "page_no").alias("page_url")), spark).where(F.col("pages") > number + 1)
        after = after.join(every.select("name", "page_url").distinct(), ["name", "page_url"], "left_anti")
        links = every.where("link IS NOT NULL").groupBy("name").agg(F.countDistinct("link").alias("n"))
        after = after.join(links.where(F.col("n") < limit), "name", "left_semi")
        if day is not None:
            youngest = dated_cards(found).groupBy("name").agg(F.max("published_date").alias("youngest"))
            after = after.join(youngest, "name", "left").where(F.col("youngest").isNull() | (F.col("youngest") >= F.date_sub(day, 1)))
        todo = after.select("name", "page_url", F.lit(number + 1).alias("page_no"))
        if todo.isEmpty():
            break
    return folder
