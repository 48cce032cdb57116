"""Feeds: RSS and Atom entries, candidate addresses, and feed text set against page text."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dom import Node, parse
from newsloom.functions.text import assess, present, strip
from newsloom.functions.urls import host
from newsloom.sources.fetching import Fetcher, Get, RequiredFetchError, SystemClock

ENTRY = "title string, url string, published_at string, summary string, content_is_full boolean"
#: Where feeds commonly are, and what a link to one is called.
COMMON_PATHS = ["feed", "rss", "atom.xml", "feed.xml", "rss.xml", "index.xml"]
FEED_TYPES = {"application/rss+xml", "application/atom+xml", "application/feed+json", "application/xml", "text/xml"}


FIELDS = {"title", "link", "description", "summary", "encoded", "content", "pubDate", "published", "updated", "created", "date"}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|(?=</?(?:item|entry|channel|rss|feed)\b)|$)|<[?!][^>]*>|<(/?)([A-Za-z_][\w:.-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTR = re.compile(r"([\w:.-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def plain(markup: str) -> str:
    """The text of a description, whose markup is escaped or stands as it is."""
    return " ".join(" ".join(n for n in _strings(parse(markup))).split()) if "<" in markup or "&" in markup else " ".join(markup.split())


def _strings(root: Node) -> Iterator[str]:
    stack: list = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            yield node
        elif node.tag not in ("script", "style"):
            stack += reversed(node.children)


def well_formed(text: str) -> list[dict[str, list[str]]] | None:
    """Fields of the entries of a feed by an XML parser; None if it is no XML."""
    try:
        root = ElementTree.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text).strip().encode())
    except ElementTree.ParseError:
        return None
    out = []
    for node in root.iter():
        if node.tag.rpartition("}")[2] not in ("item", "entry"):
            continue
        found: dict[str, list[str]] = {}
        for child in node:
            name = child.tag.rpartition("}")[2]
            if name == "link" and child.get("rel", "alternate") != "alternate":
                continue
            inner = "".join([child.text or "", *(ElementTree.tostring(c, encoding="unicode") for c in child)])  # markup that stands as it is
            found.setdefault(name, []).append((child.get("href") if name == "link" and child.get("href") else inner).strip())
        out.append(found)
    return out


def recovered(text: str) -> list[dict[str, list[str]]]:
    """Fields of the entries of a feed that is not well-formed: tags that are not closed, entities that nobody has
    declared, markup that should have been escaped, a feed that breaks off.

    A field ends where its tag does, where the next field or entry begins, or with the feed. What is inside elements of
    other names is passed over where it would be taken for the entry's own: the source of an entry has a title, too.
    """
    out: list[dict[str, list[str]]] = []
    entry: dict[str, list[str]] | None = None
    field, parts, within = "", [], 0

    def end() -> None:
        nonlocal field
        if entry is not None and field:
            entry.setdefault(field, []).append("".join(parts).strip())
        field = ""
        parts.clear()

    for token in _TOKEN.finditer(text):
        data, closing, tag, attrs = token[1], token[2], token[3], token[4] or ""
        name = tag.rpartition(":")[2] if tag else ""
        if data is not None:
            parts.append(data if field else "")
        elif not tag:
            if not token[0].startswith(("<!", "<?")):
                parts.append(html.unescape(token[0]) if field else "")
        elif name in ("item", "entry"):
            end()
            entry, within = None if closing else {}, 0
            if entry is not None:
                out.append(entry)
        elif entry is None:
            continue
        elif name in ("source", "author", "image"):
            end()
            within = 0 if closing or attrs.endswith("/") else 1
        elif within:
            continue
        elif name in FIELDS and not closing:
            end()
            values = {k: html.unescape(v or w) for k, v, w in _ATTR.findall(attrs)}
            if name == "link" and "href" in values:
                if values.get("rel", "alternate") == "alternate":
                    entry.setdefault("link", []).append(values["href"].strip())
            elif not attrs.endswith("/"):
                field = name
        elif closing and name == field:
            end()
        elif field:
            parts.append(token[0])  # markup of a text
    end()
    return out


def parse_feed(text: str, limit: int | None = None) -> list[tuple]:
    """Entries with a link: (title, url, published, longest text, whether it is the full content), ``limit`` at most.

    A feed that is not well-formed gives the entries that can be made out before and after its faults.
    """
    found = well_formed(text)
    out = []
    for fields in recovered(text) if found is None else found:
        first = lambda *names: next((fields[n][0] for n in names if fields.get(n) and fields[n][0]), "")  # noqa: B023, E731
        if not first("link"):
            continue
        texts = [(len(p), full, p) for names, full in ((("encoded", "content"), True), (("description", "summary"), False)) for n in names for t in fields.get(n, []) if (p := plain(t))]
        size, full, text_ = max(texts, key=lambda x: x[:2], default=(0, False, ""))
        out.append((plain(first("title")), first("link"), first("pubDate", "published", "date", "updated", "created"), text_, bool(size and full)))
        if limit is not None and len(out) >= limit:
            break
    return out


def entries(feeds: DataFrame, column: str = "body", limit: int | None = None) -> DataFrame:
    """Entries of feed documents (of each the first ``limit``), with each document's other columns and the entry's place."""
    rest = [c for c in feeds.columns if c != column]

    @F.pandas_udf(f"array<struct<{ENTRY.replace(' string', ':string').replace(' boolean', ':boolean').replace(', ', ',')}>>")
    def parsed(bodies: pd.Series) -> pd.Series:
        names = ["title", "url", "published_at", "summary", "content_is_full"]
        return bodies.map(lambda b: [dict(zip(names, e, strict=True)) for e in parse_feed(b or "", limit)])

    return feeds.select(*rest, F.posexplode(parsed(column)).alias("pos", "e")).select(*rest, "pos", "e.*")


def candidate_feeds(page_url: str, links: Iterator[tuple[str, str]]) -> list[str]:
    """Addresses to try for a page's feed: its declared ones (type, href), then common ones at the root and beside it."""
    root = "{0.scheme}://{0.netloc}/".format(urlsplit(page_url))
    base = page_url if page_url.endswith("/") else page_url + "/"
    declared = [urljoin(page_url, href) for kind, href in links if kind.lower() in FEED_TYPES and href]
    return list(dict.fromkeys([*declared, *(urljoin(root, p) for p in COMMON_PATHS), *(urljoin(base, p) for p in COMMON_PATHS)]))


def feed_access(name: str, url: str, protected: str, secrets: tuple[str, str], environ: dict[str, str]) -> tuple[str, tuple[str, str] | None]:
    """Address and credentials of a channel's feed: both secrets or neither; one alone is an error."""
    if name.strip().lower() != protected.lower():
        return url, None
    have = [environ.get(s, "").strip() for s in secrets]
    if any(have) and not all(have):
        raise ValueError(f"{' and '.join(secrets)} have to be set together")
    return url, (have[0], have[1]) if all(have) else None


def first_feeds(candidates: DataFrame) -> DataFrame:
    """Of the fetched candidates of each channel (``name, rank, url, body``) the first whose body has an entry:
    ``name, url, entries``. Channels without one are not there."""

    @F.pandas_udf("int")
    def count(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: len(parse_feed(b or "", 1))).astype("int32")

    some = candidates.where(F.col("body").isNotNull()).withColumn("_n", count("body")).where("_n > 0")
    best = some.groupBy("name").agg(F.min_by(F.struct("url", "body"), F.col("rank")).alias("f"))
    return entries(best.select("name", F.col("f.url").alias("feed_url"), F.col("f.body").alias("body")))


def fetch_entries(sources: DataFrame, get: Get, *, limit: int | None = 100, **pace) -> DataFrame:
    """Entries of the configured feeds of channels: ``name, feed_url`` and, where they need it, ``user, secret`` and
    ``required``. A feed that is required and cannot be had ends the job; any other one then gives nothing.

    Feeds are dealt by host and asked at its pace, as pages are.
    """
    have = set(sources.columns)
    rows = sources.select("name", "feed_url", *(F.col(c).alias(c) if c in have else F.lit(None).cast(k).alias(c) for c, k in (("user", "string"), ("secret", "string"), ("required", "boolean"))))
    make = {"clock": SystemClock} | pace

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        options = dict(make)
        fetcher = Fetcher(get, options.pop("clock")(), **options)
        for frame in frames:
            todo = [r | {"url": r["feed_url"], "pages_only": False, "auth": (r["user"], r["secret"]) if r["user"] and r["secret"] else None} for r in frame.to_dict("records")]
            out = []
            for row, (_, _, _, body, error, _) in fetcher.run(todo):
                if error and row["required"] is True:
                    raise RequiredFetchError(f"required: feed of {row['name']} ({error})")
                out.append((row["name"], row["feed_url"], body))
            yield pd.DataFrame(out, columns=["name", "feed_url", "body"])

    bodies = rows.where("feed_url <> ''").repartition(host(F.col("feed_url"))).mapInPandas(run, "name string, feed_url string, body string")
    return entries(bodies, limit=limit)


def merge_pages(pages: DataFrame, feed: DataFrame, key: str = "url") -> DataFrame:
    """Pages with what their feed entry adds: title and date where the page has none, and the feed's text if it is the
    longer one and either full or the page is not; the result is assessed anew. Of an address that a feed holds twice
    the entry with the longer text counts."""
    sized = feed.select(key, "title", "published_at", "summary", "content_is_full", F.length(present("summary")).alias("_size"), F.xxhash64("title", "published_at", "summary", "content_is_full").alias("_mark"))
    best = sized.groupBy(key).agg(F.max(F.struct("_size", "_mark")).alias("_b")).select(F.col(key).alias("_key"), "_b._size", "_b._mark")
    same = (F.col(f"s.{key}") == F.col("b._key")) & (F.col("s._size") == F.col("b._size")) & (F.col("s._mark") == F.col("b._mark"))
    once = sized.alias("s").join(best.alias("b"), same, "left_semi").dropDuplicates([key])  # what is left of a key is all the same
    e = once.select(F.col(key), F.col("title").alias("f_title"), F.col("published_at").alias("f_date"), F.col("summary").alias("f_text"), F.col("content_is_full").alias("f_full"))
    rows = pages.join(e, key, "left")
    full = F.coalesce("f_full", F.lit(False))
    takes = (full | (present("content_status") != "full")) & (F.length(strip(present("f_text"))) > F.length(strip(present("content"))))
    method = F.when(takes, F.when(full, "rss_full_content").otherwise("rss_excerpt")).otherwise(F.col("content_extraction"))
    rows = rows.select(
        key, F.coalesce(F.nullif("title", F.lit("")), "f_title", F.lit("")).alias("title"), F.coalesce(F.nullif("published_at", F.lit("")), "f_date", F.lit("")).alias("published_at"),
        F.when(takes, F.col("f_text")).otherwise(F.col("content")).alias("content"), method.alias("content_extraction"), (takes & full).alias("_full"),
    )
    verdict = assess(F.col("content"), F.col("content_extraction"), F.col("_full"))
    return rows.select(*[c for c in rows.columns if c != "_full"], verdict["status"].alias("content_status"), verdict["issue"].alias("content_issue"))


def with_feed_only(cards: DataFrame, feed: DataFrame) -> DataFrame:
    """Listing cards with their feed entry by address without fragment, and entries that no card names."""
    bare = lambda c: F.substring_index(c, "#", 1)
    c, f = cards.withColumn("_k", bare(F.col("url"))), feed.withColumn("_k", bare(F.col("url")))
    both = c.join(f.select("_k", "title", "summary"), "_k", "left").select("url", "published_date", "title", "summary", F.lit(True).alias("listed"))
    return both.unionByName(f.join(c.select("_k"), "_k", "left_anti").select("url", F.lit(None).cast("date").alias("published_date"), "title", "summary", F.lit(False).alias("listed")))
