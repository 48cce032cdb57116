"""Fetching politely: every host has one task, its own pace, its own robots and its own retries.

Addresses are dealt by host, so no two tasks ask the same host, and a task works through its hosts in the order in which
they are due: while one has to wait, the others go on. The request itself, the clock and the waiting are handed in, so
the pace can be proved without a network.
"""

from __future__ import annotations

import base64
import codecs
import heapq
import re
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import is_challenge_page, present
from newsloom.functions.urls import host, wants_browser_agent

#: Seconds between requests to a host, retries, what deserves one, and agents.
DELAY, RETRIES, RETRY_ON = 1.5, 3, {429, 500, 502, 503, 504}
BROWSER = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/138.0 Safari/537.36"
AGENT = "newsloom/1.0"
HEADERS = {"Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "en,zh-CN;q=0.9,zh;q=0.8"}
#: What a page says that is not there although its status is 200, within its first characters.
SOFT_404, PROBE = ("<h1>404 not found</h1>", "页面不存在"), 2000
FETCHED = "url string, final_url string, status int, content_type string, html string, error string, tries int"


def http_get(url: str, headers: dict[str, str], auth: tuple[str, str] | None, timeout: float = 20) -> Response:
    """A request by the standard library; redirects are followed, and answers with an error are answers."""
    request = urllib.request.Request(url, headers=HEADERS | headers)
    if auth:
        request.add_header("Authorization", "Basic " + base64.b64encode(":".join(auth).encode()).decode())
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return Response(answer.status, answer.read(), dict(answer.headers), answer.url)
    except urllib.error.HTTPError as refused:
        return Response(refused.code, refused.read(), dict(refused.headers), url)


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)
    url: str = ""

    def header(self, name: str) -> str:
        return next((v for k, v in self.headers.items() if k.lower() == name), "")


#: A request: address, headers, credentials or None. It may raise OSError.
Get = Callable[[str, dict[str, str], tuple[str, str] | None], Response]


class Clock(Protocol):
    def now(self) -> float: ...

    def sleep(self, seconds: float) -> None: ...


class SystemClock:
    def now(self) -> float:
        return time.monotonic()

    def sleep(self, seconds: float) -> None:
        time.sleep(seconds)


class RequiredFetchError(RuntimeError):
    """A page that has to be there could not be had."""


def decoded(body: bytes, content_type: str = "") -> str:
    """The text of a page: by its byte-order mark, the charset of its header (Latin-1 there says nothing), the one that
    it declares itself, UTF-8 if it is that, else GB 18030, else Latin-1."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if body.startswith(mark):
            return body[len(mark) :].decode(name, "replace")
    told = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I)
    own = re.search(rb"<\?xml[^>]*encoding\s*=\s*[\"']([\w.:-]+)|<meta[^>]*charset\s*=\s*[\"']?([\w.:-]+)", body[:4096], re.I)
    names = [told[1]] if told and told[1].lower() not in ("iso-8859-1", "latin-1") else []
    names += [(own[1] or own[2]).decode("ascii", "replace")] if own else []
    for name in [*names, "utf-8", "gb18030"]:
        name = "gb18030" if name.lower() in ("gb2312", "gbk") else name  # which holds both
        try:
            return body.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("latin-1")


def problem(response: Response, text: str, pages_only: bool) -> str | None:
    """Why a response is no page, or None."""
    kind = response.header("content-type").lower()
    if response.status >= 400:
        return f"http {response.status}"
    if pages_only and "html" not in kind:
        return "not a page"
    if not text.strip():
        return "empty"
    probe = text.strip()[:PROBE]
    if any(s in probe.lower() for s in SOFT_404):
        return "soft 404"
    return None


class Host:
    """What a task knows of one host: its robots, when it may be asked again, and what is still to be asked."""

    def __init__(self) -> None:
        self.due = 0.0
        self.robots: RobotFileParser | None = None
        self.todo: deque = deque()


class Fetcher:
    """Asks addresses of many hosts, each at its own pace."""

    def __init__(self, get: Get, clock: Clock, *, delay: float = DELAY, retries: int = RETRIES, agent: str = AGENT, respect_robots: bool = True) -> None:
        self.get, self.clock, self.delay, self.retries, self.agent, self.respect_robots = get, clock, delay, retries, agent, respect_robots
        self.hosts: dict[str, Host] = {}

    def _ask(self, own: Host, url: str, headers: dict[str, str], auth: tuple[str, str] | None) -> Response:
        """One request, not before the host is due; failures of the connection are answered with status 0."""
        if (wait := own.due - self.clock.now()) > 0:
            self.clock.sleep(wait)
        try:
            return self.get(url, headers, auth)
        except OSError as gone:
            return Response(0, str(gone).encode() or type(gone).__name__.encode())
        finally:
            own.due = self.clock.now() + self.delay

    def _allowed(self, own: Host, url: str, headers: dict[str, str]) -> bool:
        if own.robots is None:
            parts = urlsplit(url)
            own.robots = RobotFileParser()
            answer = self._ask(own, f"{parts.scheme}://{parts.netloc}/robots.txt", headers, None)
            own.robots.parse(decoded(answer.body, answer.header("content-type")).splitlines() if 0 < answer.status < 400 else [])
        return own.robots.can_fetch(headers["User-Agent"], url)

    def one(self, own: Host, url: str, browser: bool = False, auth: tuple[str, str] | None = None, pages_only: bool = True) -> tuple:
        """``FETCHED`` without the address: retries wait nothing, 2, 4, ... seconds, or what the host asks for."""
        headers = {"User-Agent": BROWSER if browser else self.agent}
        if urlsplit(url).scheme not in ("http", "https"):
            return url, None, None, None, "not an address", 0
        if self.respect_robots and not self._allowed(own, url, headers):
            return url, None, None, None, "robots", 0
        answer, tries = Response(0), 0
        while True:
            answer, tries = self._ask(own, url, headers, auth), tries + 1
            if tries > self.retries or answer.status not in RETRY_ON | {0}:
                break
            after = answer.header("retry-after")
            own.due = max(own.due, self.clock.now() + max(2.0 ** (tries - 1) if tries > 1 else 0.0, float(after) if after.isdigit() else 0.0))
        kind = answer.header("content-type")
        if answer.status == 0:
            return url, None, None, None, f"no answer: {answer.body.decode(errors='replace')}", tries
        text = decoded(answer.body, kind)
        error = problem(answer, text, pages_only)
        return answer.url or url, answer.status, kind, None if error else text, error, tries

    def run(self, rows: list[dict]) -> Iterator[tuple[dict, tuple]]:
        """Rows ``url, browser, auth, pages_only`` with what came of them; the host that is due first goes first."""
        for row in rows:
            self.hosts.setdefault(urlsplit(row["url"] or "").netloc, Host()).todo.append(row)
        queue = [(own.due, i, own) for i, own in enumerate(self.hosts.values()) if own.todo]
        heapq.heapify(queue)
        while queue:
            _, i, own = heapq.heappop(queue)
            row = own.todo.popleft()
            yield row, self.one(own, row["url"] or "", bool(row.get("browser")), row.get("auth"), row.get("pages_only", True))
            if own.todo:
                heapq.heappush(queue, (own.due, i, own))


def fetch(urls: DataFrame, get: Get, *, clock: Callable[[], Clock] = SystemClock, delay: float = DELAY, retries: int = RETRIES, agent: str = AGENT, respect_robots: bool = True, pages_only: bool = True, required: bool = False) -> DataFrame:
    """Pages of distinct addresses (``url``): ``FETCHED``, with an error in place of a page that could not be had.

    A host is one task's, however many of the addresses are its: that is what a pace for each host asks for. With
    ``required`` a page that cannot be had ends the job. Null addresses are left out. The result is not kept: write it
    before it is used twice.
    """
    asked = urls.where(F.col("url").isNotNull()).select("url").distinct().withColumn("browser", wants_browser_agent(F.col("url")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = Fetcher(get, clock(), delay=delay, retries=retries, agent=agent, respect_robots=respect_robots)
        for frame in frames:
            out = []
            for row, got in fetcher.run(frame.assign(pages_only=pages_only)[["url", "browser", "pages_only"]].to_dict("records")):
                if required and got[4]:
                    raise RequiredFetchError(f"required: {row['url']} ({got[4]})")
                out.append((row["url"], *got))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FETCHED.split(", ")]).astype({"status": "Int32"})

    dealt = asked.repartition(host(F.col("url"))).sortWithinPartitions("url")
    rows = dealt.mapInPandas(run, FETCHED)
    challenge = is_challenge_page(present("html"))
    return rows.withColumn("error", F.when(challenge, "access challenge").otherwise(F.col("error"))).withColumn("html", F.when(~challenge, F.col("html")))
