"""URL functions: comparison keys, sites, article paths, feed addresses, request headers."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Query keys that only track, suffixes of two labels, paths of articles, hosts that want a browser.
TRACKING = ["fbclid", "gclid", "mc_cid", "mc_eid"]
COMPOUND_SUFFIXES = ["com.cn", "net.cn", "org.cn", "co.uk", "com.au"]
ARTICLE_PATHS = [
    r"/20\d{2}(?:\d{2})?/\d{1,2}/[^/]+\.s?html?$", r"/20\d{4}/[^/]+\.s?html?$", r"(?i)/20\d{6}/[a-z0-9-]+/c\.html?$", r"(?i)/20\d{2}/\d{1,2}/\d{1,2}/\d+/[^/?#]+/?$",
    r"(?i)/story/[^/?#]+/\d+\.article/?$", r"(?i)/html/[^/?#]+\.s?html?$", r"(?i)/tech/\d+\.s?html?$", r"(?i)/news/article/[a-z0-9]+\.s?html?$", r"/\d{6}/\d+\.s?html?$",
    r"/t20\d{6}_\d+\.s?html?$", r"/article/\d+\.s?html?$", r"(?i)/news/(?!news_list_)[^/?#]+\.s?html?$",
]
BROWSER_HOSTS = ["sciencenet.cn", "insideevs.com"]
DEFAULT_PORTS = {"http": 80, "https": 443}


def url_key(url: str | None) -> str:
    """A stable key of an address: https, bare lower-case host, path without its last slash, sorted query without tracking."""
    value = (url or "").strip()
    try:
        parts = urlsplit(value)
        port, host = parts.port, (parts.hostname or "").lower()
    except ValueError:
        return value.rstrip("/")
    if not parts.netloc:
        return value.rstrip("/")
    host = host.removeprefix("www.")
    scheme = parts.scheme.lower()
    if port and DEFAULT_PORTS.get(parts.scheme) != port:
        host = f"{host}:{port}"
    kept = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k.lower() not in TRACKING and not k.lower().startswith("utm_")]
    return urlunsplit(("https" if scheme in DEFAULT_PORTS else scheme, host, parts.path.rstrip("/") or "/", urlencode(sorted(kept)), ""))


@F.pandas_udf(T.StringType())
def canonical_url(urls: pd.Series) -> pd.Series:
    """``url_key`` for any address, in Arrow batches; each distinct address once."""
    return urls.map({u: url_key(u) for u in urls.unique()})


def canonical_url_native(url: Column) -> Column:
    """``url_key`` without Python, for addresses of ASCII letters, digits and ``-._~`` between delimiters; else null.

    Nothing in such an address is escaped, so keys and values stay as they are.
    """
    value = F.trim(F.coalesce(url, F.lit("")))
    plain = value.rlike(r"^https?://[A-Za-z0-9.-]+(?::\d+)?(?:/[A-Za-z0-9._~/-]*)?(?:\?[A-Za-z0-9._~&=-]*)?(?:#.*)?$")
    part = lambda pattern: F.regexp_extract(value, pattern, 1)
    scheme, host, port = part(r"^(https?)://"), F.regexp_replace(F.lower(part(r"^https?://([A-Za-z0-9.-]+)")), r"^www\.", ""), part(r"^https?://[A-Za-z0-9.-]+:(\d+)")
    standard = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_replace(part(r"^https?://[^/?#]+(/[^?#]*)"), r"/+$", "")
    pairs = F.filter(F.split(part(r"^[^?#]*\?([^#]*)"), "&"), lambda p: p != "")
    pairs = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(p.contains("="), F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).otherwise("").alias("v")))
    pairs = F.filter(pairs, lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(TRACKING))
    query = F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["k"], F.lit("="), F.regexp_replace(p["v"], "=", "%3D"))), "&")
    key = F.concat(F.lit("https://"), host, F.when(standard, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(value == "", "").when(plain, key)


def address_key(url: Column) -> Column:
    """``url_key`` for any address: in the JVM for plain ones, in Python only for those that need re-encoding."""
    native = canonical_url_native(url)
    return F.coalesce(native, canonical_url(F.when(native.isNull(), url)))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def registrable_site(host: Column) -> Column:
    """The last two labels of a host, three after a compound suffix; without port and ``www.``."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.substring_index(host, ":", 1)), r"\.+$", ""), r"^www\.", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    two = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(n - 2, F.lit(1)), F.lit(3)), ".")
    return F.when((n >= 3) & two.isin(COMPOUND_SUFFIXES), three).when(n >= 2, two).otherwise(bare)


def same_site(a: Column, b: Column) -> Column:
    return registrable_site(a) == registrable_site(b)


def is_article_path(path: Column) -> Column:
    return reduce(lambda x, y: x | y, [path.rlike(p) for p in ARTICLE_PATHS])


def feed_url(note: Column) -> Column:
    """The feed address that a channel's note names; empty without one."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(note, F.lit("")), r"(?:RSS|rss)\s*[:：]\s*(https?://[^\s。；;,，]+)", 1), r"[。；;，,]+$", "")


def wants_browser_agent(url: Column) -> Column:
    h = host(url)
    return reduce(lambda x, y: x | y, [(h == d) | h.endswith("." + d) for d in BROWSER_HOSTS])


def resolve_canonical(requested: str, declared: str | None, date_of) -> str:
    """The page's declared address, unless it is a placeholder, not http(s), or dated differently from the one asked for."""
    target = urljoin(requested, (declared or "").strip())
    if not (declared or "").strip() or re.search(r"[\[\]{}]", declared) or urlsplit(target).scheme not in DEFAULT_PORTS or not urlsplit(target).netloc:
        return requested
    own, other = date_of(requested), date_of(target)
    return requested if own and other and own != other else target
