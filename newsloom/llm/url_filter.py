"""Operator 10, URL filters: rules on host and path, with decisions that follow redirects and canonical links.

Pages that redirect to one another, or name one another as canonical, are one resource under several addresses.
The connected components of those links carry a block decision from one address to its aliases; an explicit
allow in the component takes precedence over a block that merely arrives over a link.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.components import connected_components
from newsloom.llm.storage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased, else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def key_of(url: Column) -> Column:
    """The address without scheme and fragment: host, path and query. Null where there is no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits. Rules are pairs of ``allow`` or ``block`` and ``host/path``."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1]))
    for what, rule in reversed(ranked):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def absolute(target: Column, base: Column) -> Column:
    """A link's address, completed from its page: its scheme, host, folder or path. Null for addresses that are no
    pages, as those of a ``mailto:``."""
    target = F.regexp_replace(F.trim(target), "&amp;", "&")
    here = F.concat(F.lit("http://"), host_of(base))
    path = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    return (
        F.when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), target)
        .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(here, target))
        .when(target.startswith("?"), F.concat(here, path, target))
        .when(target.startswith("#"), base)
        .otherwise(F.concat(here, without_dots(F.concat(F.regexp_extract(path, r"^(.*/)", 1), F.regexp_extract(target, r"^([^?#]*)", 1))), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)))
    )


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` steps taken."""
    steps = F.split(path, "/")
    last = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    shorter = lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1)))
    taken = F.aggregate(steps, F.array().cast("array<string>"), lambda a, x: F.when(x == "..", shorter(a)).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    return F.array_join(F.concat(taken, last), "/")


def declared_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Canonical links and meta refreshes of the pages, all of each: ``source`` and ``target`` keys."""
    body = F.col(html)
    tags = F.regexp_extract_all(body, F.lit(r"(?is)(<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>)"), 1)
    canonical = F.transform(tags, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    metas = F.regexp_extract_all(body, F.lit(r"(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)"), 1)
    refresh = F.transform(metas, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*['\"]?([^\"'\s>;]+)", 1))
    return (
        pages.where(body.rlike(r"(?i)\brel\s*=\s*[\"']?canonical|\bhttp-equiv\s*=\s*[\"']?refresh"))
        .select(F.col(url).alias("base"), F.explode(F.concat(canonical, refresh)).alias("target"))
        .where("target <> ''")
        .select(key_of(F.col("base")).alias("source"), key_of(absolute(F.col("target"), F.col("base"))).alias("target"))
        .where("source IS NOT NULL AND target IS NOT NULL AND source <> target")
    )


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], *, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """Judges every page: ``page_id, host, path, rule, verdict, component``.

    A page's own rule decides. Without one, the page is blocked if its component holds an address that a rule
    blocks and none that a rule allows; any other page is allowed. ``redirects`` holds further links as addresses
    ``source`` and ``target``. ``component`` is the smallest address key that links reach, or null for a page
    without links.

    Null addresses and those without ``://`` have an empty host and path, fit no rule and have no aliases, so they
    are allowed. Null html has no links. Repeated rows are judged each for itself; an empty table gives none; other
    columns are ignored, whatever their names.
    """
    rules = list(rules)
    links = declared_links(pages.select(F.col(url).alias("url"), F.col(html).alias("html"))) if html else None
    if redirects is not None:
        more = redirects.select(key_of(F.col("source")).alias("source"), key_of(F.col("target")).alias("target")).where("source IS NOT NULL AND target IS NOT NULL AND source <> target")
        links = more if links is None else links.unionByName(more)
    judged = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), key_of(F.col(url)).alias("key"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("page_id", "host", "path", name.alias("rule"), verdict.alias("own"), "key")
    links = None if links is None else written(links.distinct(), "links")
    if links is None or links.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"), F.lit(None).cast("string").alias("component"))
    nodes = written(connected_components(links, "source", "target"), "aliases")
    host, path = F.regexp_extract("node", r"^([^/?#]*)", 1), F.regexp_extract("node", r"^[^/?#]*([^?]*)", 1)
    _, ruled = rule_of(host, path, rules)
    spread = nodes.groupBy("component").agg(F.max(ruled == "allow").alias("allowed"), F.max(ruled == "block").alias("blocked"))
    spread = spread.select("component", (F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).alias("inherits"))
    spread = written(spread, "alias-verdicts")  # a row for each group: its members are the side of the join that Spark splits
    nodes = written(nodes.join(spread, "component").select(F.col("node").alias("key"), "component", "inherits"), "alias-verdicts")
    verdict = F.coalesce(F.col("own"), F.when(F.col("inherits"), F.lit("block")).otherwise(F.lit("allow")))
    # Pages without a host have no key; a number of their own spreads them over the tasks.
    spot = F.coalesce("key", F.concat(F.lit("/"), F.xxhash64("page_id", F.monotonically_increasing_id()).cast("string")))
    return judged.withColumn("key", spot).join(nodes, "key", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")
