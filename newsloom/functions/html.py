"""HTML: titles, dates, bodies and links of pages, by the standard library's parser in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import extract, free_dates
from newsloom.functions.dates import published_date, url_date
from newsloom.functions.dom import NOISE, Node, parse
from newsloom.functions.selectors import select
from newsloom.functions.text import assess, repaired_title, trim_body
from newsloom.functions.urls import resolve_canonical

#: A date in an address, as far as two addresses can be told apart by it.
DATE_IN_URL = r"20\d{2}[-/]?\d{1,2}[-/]?\d{1,2}"
#: Meta tags of dates.
DATE_METAS = ["article:published_time", "publishdate", "pubdate", "date", "dc.date", "og:published_time", "weibo:article:create_at"]
#: Ids and classes of elements that hold a date, and how it is written there.
DATE_IDS, DAY_FIRST = re.compile(r"(?:published|publish).*date", re.I), re.compile(r"\d{1,2}/\d{1,2}/20\d{2}")
DATE_CLASSES = ["time-source-address", "article-time", "publish-time", "publish-date", "pubtime", "showtitinfo", "qr_code", "date", "time"]
DATE_VALUE = re.compile(r"(20\d{2}[-/.]\d{1,2}[-/.]\d{1,2}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?)")
#: Fixed value: channels that write the day before the month.
DAY_FIRST_CHANNELS = ["4c offshore"]
#: How the text of a page was found if its lines decided, not one element.
FULL_TEXT = "block_full_text"
#: Channels whose body is in one element and nowhere else; ids, classes, and elements within elements.
STRICT = {
    "中国能源网": "#showcontent",
    "interesting engineering": ".body-content",
    "batteries news": ".entry-content",
    "data center knowledge": ".ArticleBase-BodyContent_Article",
    "pv magazine c&i pv": ".pvmagazine-post-content .entry-content",
    "新华网科技": ".main-left.left",
}


def metas(root: Node) -> dict[str, str]:
    out: dict[str, str] = {}
    for n in root.walk():
        if n.tag == "meta" and (name := (n.attrs.get("property") or n.attrs.get("name") or n.attrs.get("itemprop") or "").lower()):
            out.setdefault(name, n.attrs.get("content", "").strip())
    return out


def json_ld(root: Node) -> Iterator[dict]:
    """All objects in JSON-LD scripts, inner ones too."""
    for n in root.walk():
        if n.tag == "script" and "ld+json" in n.attrs.get("type", ""):
            try:
                stack = [json.loads("".join(c for c in n.children if isinstance(c, str)))]
            except ValueError:
                continue
            while stack:
                x = stack.pop()
                if isinstance(x, dict):
                    yield x
                    stack += reversed(list(x.values()))
                elif isinstance(x, list):
                    stack += reversed(x)


def title(root: Node) -> str:
    """og or twitter title, else the first heading, else the page's title."""
    m = metas(root)
    found = [m.get("og:title", ""), m.get("twitter:title", "")]
    found += [next((n.text() for n in root.walk() if n.tag == tag and n.text()), "") for tag in ("h1", "title")]
    return next((t for t in found if t), "")


def published(root: Node) -> str:
    """A publication time as written: in meta tags, a time element, JSON-LD, or beside a label."""
    m = metas(root)
    if value := next((m[k] for k in DATE_METAS if m.get(k)), ""):
        return value
    for n in root.walk():
        if n.tag == "time" and (n.attrs.get("datetime") or n.text()):
            return n.attrs.get("datetime") or n.text()
    for x in json_ld(root):
        if isinstance(x.get("datePublished"), str):
            return x["datePublished"]
    found = re.search(r"(?:发布时间|发布日期|时间|日期|Published)\s*[:：]?\s*(\d{4}[-/.年]\d{1,2}[-/.月]\d{1,2}日?(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?)", root.text(frozenset(NOISE - {"header"})))
    if found:
        return found[1]
    for n in root.walk():
        if DATE_IDS.search(n.attrs.get("id", "")):
            if DAY_FIRST.fullmatch(text := n.text()):
                return text
            break  # the first such element decides
    for name in DATE_CLASSES:
        for n in root.walk():
            if name in n.attrs.get("class", "").split() and (found := DATE_VALUE.search(n.text())):
                return found[1]
    return ""


def body(root: Node) -> tuple[str, str]:
    """Text and how it was found: the element that scores best, or a longer JSON-LD body."""
    best = extract.best_block(root)
    ld = max((x["articleBody"].strip() for x in json_ld(root) if isinstance(x.get("articleBody"), str)), key=len, default="")
    return (ld, "json_ld") if len(ld) > len(best) else (best, "dom_or_structured_full_text" if best else "")


def strict_body(root: Node, source: str) -> str | None:
    """The longest text of a channel's one body element, empty if a page has none; null for channels without one."""
    selector = STRICT.get((source or "").strip().lower())
    if selector is None:
        return None
    return max((extract.own_text(n) for n in select(root, selector)), key=len, default="")


def page_articles(pages: DataFrame, *, url: str = "url", html: str = "html", source: str = "source_name") -> DataFrame:
    """Pages as articles: ``url, source_name, title, published_at, content, content_extraction, content_status,
    content_issue, requested_url``.

    The address is the declared one, unless that is a placeholder or dated differently. A date in the address goes
    before the one written on the page. The body is the best element's text or the full text of the page, whichever is
    longer once it is cut at stop markers and legal lines; channels with one body element take that if it is there. The
    title of the channel that names itself is repaired, and the completeness is judged. Pages without title and text are left out; null pages
    are such; other columns are left out.
    """
    pages = pages.select(F.col(url).alias("url"), F.col(html).alias("html"), F.coalesce(source, F.lit("")).alias("source_name"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for address, page, name in zip(frame["url"], frame["html"], frame["source_name"], strict=True):
                root = parse(page)
                content, method = body(root)
                full = extract.full_text(root)
                own = strict_body(root, name)
                if own is not None:  # the one element bounds the body; without it the page has what the full text finds
                    content, method, full = (own, "dom_or_structured_full_text", "") if own else ("", "", full)
                declared = next((n.attrs.get("href", "") for n in root.walk() if n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower()), "") or metas(root).get("og:url", "")
                target = resolve_canonical(address or "", declared, lambda u: (re.search(DATE_IN_URL, u) or [""])[0])
                written = published(root)
                day_first = (name or "").strip().lower() in DAY_FIRST_CHANNELS
                rows.append((target, name, title(root), written, free_dates.read(written, day_first), content, method, full, address))
            yield pd.DataFrame(rows, columns=["url", "source_name", "title", "written", "read", "content", "method", "full", "requested_url"])

    made = pages.mapInPandas(run, "url string, source_name string, title string, written string, read string, content string, method string, full string, requested_url string")
    made = made.withColumn("content", trim_body(F.col("content"))).withColumn("full", trim_body(F.col("full")))
    longer = F.length("full") > F.length("content")
    made = made.withColumn("method", F.when(longer, FULL_TEXT).otherwise(F.col("method"))).withColumn("content", F.when(longer, F.col("full")).otherwise(F.col("content")))
    made = made.where("title <> '' OR content <> ''")
    dated = F.coalesce(url_date(F.col("url")), published_date(F.col("written"), F.lower(F.trim("source_name")).isin(DAY_FIRST_CHANNELS)), F.col("read").cast("date"))
    rows = made.select("url", "source_name", "title", F.coalesce(dated.cast("string"), "written").alias("published_at"), "content", F.col("method").alias("content_extraction"), "requested_url")
    rows = rows.withColumn("title", repaired_title(F.col("title"), F.col("content"), F.col("source_name"))).withColumn("_v", assess(F.col("content"), F.col("content_extraction")))
    return rows.select("url", "source_name", "title", "published_at", "content", "content_extraction", F.col("_v.status").alias("content_status"), F.col("_v.issue").alias("content_issue"), "requested_url")


def links(root: Node, base: str) -> list[tuple[str, str]]:
    return [(urljoin(base, n.attrs["href"]), n.text()) for n in root.walk() if n.tag == "a" and n.attrs.get("href") and not n.attrs["href"].startswith(("#", "javascript:", "mailto:"))]


def articles(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Title, time, text and declared address of pages, beside their other columns; pages without title and text go."""
    keep = [c for c in pages.columns if c != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html), "title string", "published_at string", "content string", "content_extraction string", "declared_url string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame[html]:
                root = parse(text)
                content, method = body(root)
                declared = next((n.attrs.get("href", "") for n in root.walk() if n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower()), "")
                rows.append((title(root), published(root), content, method, declared))
            made = pd.DataFrame(rows, columns=["title", "published_at", "content", "content_extraction", "declared_url"], index=frame.index)
            yield pd.concat([frame[keep], made], axis=1)[(made["title"] != "") | (made["content"] != "")]

    return pages.mapInPandas(run, schema)


def heads(pages: DataFrame, html: str = "html", terminated: bool = False) -> DataFrame:
    """What pages say of themselves, beside their other columns: title, time and declared address; no body is read.
    ``terminated`` as ``parse`` has it."""
    keep = [c for c in pages.columns if c != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html), "title string", "published_at string", "declared_url string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            roots = [parse(text, terminated) for text in frame[html]]
            rows = [(title(r), published(r), next((n.attrs.get("href", "") for n in r.walk() if n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower()), "")) for r in roots]
            yield pd.concat([frame[keep], pd.DataFrame(rows, columns=["title", "published_at", "declared_url"], index=frame.index)], axis=1)

    return pages.mapInPandas(run, schema)


def bodies(pages: DataFrame, html: str = "html", terminated: bool = False) -> DataFrame:
    """Texts of pages, beside their other columns: ``body`` of the best element, how it was found, and ``full_text``;
    ``terminated`` as ``parse`` has it."""
    keep = [c for c in pages.columns if c != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html), "body string", "method string", "full_text string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            roots = [parse(text, terminated) for text in frame[html]]
            rows = [(*body(r), extract.full_text(r)) for r in roots]
            yield pd.concat([frame[keep], pd.DataFrame(rows, columns=["body", "method", "full_text"], index=frame.index)], axis=1)

    return pages.mapInPandas(run, schema)


def listing(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links of listing pages in their order: the page's address, ``pos, link, title``; the first of each address."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for base, text in zip(frame[url], frame[html], strict=True):
                seen: dict[str, str] = {}
                for target, label in links(parse(text), base or ""):
                    seen.setdefault(target.split("#")[0], label)
                out += [(base, k, target, label) for k, (target, label) in enumerate(seen.items())]
            yield pd.DataFrame(out, columns=["page_url", "pos", "link", "title"])

    return pages.select(F.col(url), F.col(html)).mapInPandas(run, "page_url string, pos int, link string, title string")
