"""Text functions: trimming, completeness of articles, redaction, clipping."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers of access challenges in texts and in pages, of paywalls, and endings of cut texts.
TEXT_CHALLENGES = [("cf_app_waf", "requestinfo"), ("checking your browser", "enable javascript and cookies"), ("verify you are human", "cloudflare")]
PAGE_CHALLENGES = [("cf_app_waf", "requestinfo"), ("cf-chl-", "challenge-platform"), ("checking your browser", "enable javascript and cookies"), ("verify you are human", "cloudflare")]
PAYWALLS = [
    "subscribe to unlock", "subscribe to continue", "subscribe to read", "sign in to continue", "log in to continue", "register to continue", "already a subscriber",
    "this article is for subscribers", "仅限会员", "会员专享", "登录后阅读全文", "订阅后阅读全文", "付费后阅读全文",
]
CUT_ENDING = r"(?i)(\.{3}|…|read more|continue reading|阅读全文|查看全文|点击展开)\s*$"
#: Characters at the end of a stripped text that hold any of these endings.
CUT_CHARS = 20
#: Where a page's body stops, lines of legal notices that end it, what a line begins with that is a label,
#: and the channel that gives its own name for a title.
STOP_MARKERS = [
    "\nPopular content\n", "\nRelated Articles\n", "\nRelated Stories\n", "\nAdvertisement\n", "\nAdvertisements\n", "\nShare\n", "\nSign up for Battery Technology newsletters\n",
    "\nWant more Battery Technology in your search results?\n", "\nYour Privacy Choices\n", "\nExplore more about Hymson", "\nThis is a sponsored article", "\n相关阅读\n", "\n相关推荐\n", "\n热门推荐\n",
    "\n更多新闻\n", "\n版权声明\n", "\n免责声明\n",
]
LEGAL_LINES = [
    "版权声明", "免责声明", "版权归", "未经授权", "如需转载", "This content is protected by copyright", "If you want to cooperate", "This is a sponsored article", "If you'd like to inquire",
    "If you’d like to inquire", "Explore more about", "Sign up for Battery Technology newsletters", "Want more Battery Technology in your search results", "Your Privacy Choices",
]
LABELS = (
    r"(?iU)^(?:source|from|author|by|published|updated|editor|copyright|tags?|share|newsletter|sign up|want more|your privacy choices|advertisement|sponsored|来源|来自|作者|记者|编辑|责任编辑|"
    r"发布时间|发布日期|时间|关键词|标签|声明|版权|分享到|分享|打印|字号|阅读|浏览|打开网易新闻 查看精彩图片|上一篇|下一篇|相关|推荐|热门|更多)\b|"
    r"^(?:来源|作者|编辑|责任编辑|发布时间|发布日期|时间|关键词|标签|版权|声明)[：:]"
)
NAMED = "ne时代"
SECRET = r"(?i)((?:access[_-]?token|api[_-]?key|password|secret|authorization)(?:%3[dD]|=|:)\s*)[^&\s,;]+"
RANKS = {"missing": 0, "unknown": 1, "incomplete": 2, "full": 3}
#: The blanks of Unicode.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0                　"


def present(c: Column | str) -> Column:
    """A missing value as the empty string."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without blanks of any kind at both ends; null stays null."""
    return F.trim(c, F.lit(BLANKS))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def has_all_of(lowered: Column, groups: list[tuple[str, ...]]) -> Column:
    """Whether all markers of some group are in a text."""
    return _any([reduce(lambda a, b: a & b, [lowered.contains(m) for m in g]) for g in groups])


def is_challenge(content: Column) -> Column:
    return has_all_of(F.lower(present(content)), TEXT_CHALLENGES)


def is_challenge_page(html: Column) -> Column:
    """Whether a page's first 100,000 characters are an access challenge."""
    return has_all_of(F.lower(F.left(present(html), F.lit(100_000))), PAGE_CHALLENGES)


def assess(content: Column, method: Column = None, declared_full: Column = None) -> Column:
    """Completeness of a text as a struct (status, issue); the first rule that holds decides.

    The text in lower case is made once, and the verdict is the number of one rule, looked up in a constant.
    """
    method = present(method) if method is not None else F.lit("")
    declared = F.coalesce(declared_full, F.lit(False)) if declared_full is not None else F.lit(False)

    def verdict(low: Column) -> Column:
        rules = [
            (low == "", "missing", "empty_content"),
            (has_all_of(low, TEXT_CHALLENGES), "missing", "access_challenge"),
            (_any([low.contains(m) for m in PAYWALLS]), "incomplete", "paywall_or_login_wall"),
            (F.right(low, F.lit(CUT_CHARS)).rlike(CUT_ENDING), "incomplete", "truncated_ending"),
            ((method == "rss_excerpt") & ~declared, "incomplete", "rss_excerpt_only"),
            (method == "public_preview", "incomplete", "public_preview_only"),
            (method != "", "full", ""),
            (F.lit(True), "unknown", "legacy_record_not_verified"),
        ]
        named = F.array(*(F.struct(F.lit(status).alias("status"), F.lit(issue).alias("issue")) for _, status, issue in rules))
        number = reduce(lambda out, k: F.when(rules[k][0], k).otherwise(out), range(len(rules) - 2, -1, -1), F.lit(len(rules) - 1))
        return F.get(named, number)

    return once(F.lower(strip(present(content))), verdict)


def content_rank(status: Column) -> Column:
    """missing 0, unknown and anything else 1, incomplete 2, full 3."""
    return once(F.lower(strip(present(status))), lambda low: reduce(lambda out, kv: F.when(low == kv[0], kv[1]).otherwise(out), RANKS.items(), F.lit(1)))


def title_key(title: Column) -> Column:
    """Lower case, one blank between words, none around."""
    return strip(F.regexp_replace(F.lower(present(title)), r"(?U)\s+", " "))


def clean(text: Column) -> Column:
    """One blank for runs of blanks and tabs, two newlines for three and more."""
    return strip(F.regexp_replace(F.regexp_replace(present(text), r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def redact(text: Column, limit: int = 2000) -> Column:
    """Values of secrets replaced, then cut."""
    return F.left(F.regexp_replace(present(text), SECRET, "$1[REDACTED]"), F.lit(limit))


def redacted(text: str) -> str:
    """``redact`` for one text that is already on the driver."""
    return re.sub(SECRET, r"\1[REDACTED]", text)


def clip(text: Column, limit: int) -> Column:
    """Head (72 %) and tail of a long text around a marker, on collapsed blanks."""
    flat = strip(F.regexp_replace(present(text), r"(?U)\s+", " "))
    head = max(int(limit * 0.72), 1)
    tail = max(limit - head - 12, 1)
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.left(flat, F.lit(head)), F.lit("\n……[正文截断]……\n"), F.right(flat, F.lit(tail))))


def is_body_line(line: Column) -> Column:
    """Whether a stripped line is body: not short, no address, domain, label or mere date."""
    apart = line.rlike(r"(?i)[\w.+-]+@[\w.-]+\.[a-z]{2,}") | line.rlike(r"(?i)^(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/\S*)?$") | line.rlike(LABELS) | line.rlike(r"^[\d\s:/.\-年月日时分秒]+$")
    return (F.length(line) >= 8) & ~apart


def trim_body(text: Column) -> Column:
    """The body of a page's text: up to the first stop marker or legal line, its body lines only.

    A marker at the very beginning stops nothing.
    """

    def shortened(t: Column) -> Column:
        at = [F.instr(t, m) for m in STOP_MARKERS]
        ends = F.least(*(F.when(a > 1, a - 1).otherwise(F.length(t)) for a in at))
        return F.left(t, ends)

    def kept(lines: Column) -> Column:
        legal = F.array_position(F.transform(lines, lambda x: _any([x.contains(m) for m in LEGAL_LINES])), F.lit(True))
        return F.filter(F.slice(lines, F.lit(1), F.when(legal > 0, legal - 1).otherwise(F.size(lines)).cast("int")), is_body_line)

    lines = F.transform(F.split(once(clean(text), shortened), "\n"), strip)
    return clean(F.array_join(once(lines, kept), "\n"))


def repaired_title(title: Column, content: Column, source: Column) -> Column:
    """The title, or for the channel NAMED that puts its own name there, the first other line of the text, cut to 500."""
    named = lambda c: F.lower(strip(present(c))) == NAMED
    lines = F.filter(F.transform(F.split(present(content), r"\r\n|\n|\r"), strip), lambda x: (x != "") & (F.lower(x) != NAMED))
    return F.when(named(source) & (named(title) | (strip(present(title)) == "")), F.coalesce(F.left(F.get(lines, F.lit(0)), F.lit(500)), title)).otherwise(title)


def body_lines(text: Column) -> Column:
    """Lines of a body that are neither short nor an address, a bare domain or a date: an array."""
    lines = F.transform(F.split(present(text), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(lines, lambda x: (F.length(x) >= 8) & ~x.rlike(r"[\w.+-]+@[\w-]+\.[\w.-]+") & ~x.rlike(r"^(?:https?://)?(?:www\.)?[\w-]+(?:\.[\w-]+)+/?$") & ~x.rlike(r"^\d{4}[-/.年]\d{1,2}[-/.月]\d{1,2}日?(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?$"))
