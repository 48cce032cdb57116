"""Edges to the outside as injected interfaces: delivery of messages, signing, downloads. Fetching is in ``fetching``."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
from collections.abc import Callable
from urllib.parse import quote_plus, urlsplit

from pyspark.sql import DataFrame

from newsloom.functions.text import redacted

#: Where alerts may go, what they are called, and how states of incidents are put.
WEBHOOK_SITE, KEYWORD = "dingtalk.com", "渠道抓取告警"
STATUS_LABELS = {"pending_confirmation": "待人工确认", "recovery_failed": "补抓失败", "recovered": "补抓成功"}


class NotificationError(RuntimeError):
    """A message that its service did not take."""


def signature(secret: str, millis: int) -> str:
    """What a chat webhook wants beside its address: HMAC-SHA256 of time and secret, base64, quoted."""
    return quote_plus(base64.b64encode(hmac.new(secret.encode(), f"{millis}\n{secret}".encode(), hashlib.sha256).digest()))


def signed_url(webhook: str, secret: str, millis: int) -> str:
    """The address of a webhook with time and signature, if there is a secret; addresses of other sites, or without
    encryption, are refused, so that a setting that is wrong sends nothing to a stranger."""
    parts = urlsplit(webhook)
    name = (parts.hostname or "").lower()
    if parts.scheme != "https" or not (name == WEBHOOK_SITE or name.endswith("." + WEBHOOK_SITE)):
        raise ValueError(f"the webhook has to be an https address at {WEBHOOK_SITE}")
    if not secret:
        return webhook
    return f"{webhook}{'&' if parts.query else '?'}timestamp={millis}&sign={signature(secret, millis)}"


def safe(value: object, limit: int = 500) -> str:
    """A value in one line, secrets blanked, cut to a length."""
    return redacted(str(value or "").replace("\n", " "))[:limit]


def alert(rows: list[dict], total: int, keyword: str = KEYWORD, run_url: str = "", cap: int = 30) -> str:
    """Changes of incidents as a Markdown message, the first ``cap`` of them in full."""
    lines = [f"## {keyword}", "", f"> 共检测到 **{total}** 条渠道状态变化", ""]
    for r in rows[:cap]:
        first = lambda *names: next((r[n] for n in names if r.get(n)), "")  # noqa: B023, E731
        cause, raw = safe(first("last_error", "diagnosis", "technical_reason") or "未记录原因"), safe(r.get("technical_reason"))
        lines += [
            f"### {STATUS_LABELS.get(r['status'], r['status'])}｜{r['source']}", f"- 缺失日期：{r['date']}", f"- 发生/发现时间：{safe(first('failed_at', 'last_attempt_at', 'detected_at', 'updated_at') or '-')}",
            f"- 错误类型：`{safe(first('error_type', 'diagnosis_code') or '-')}`", f"- 诊断：{cause}", f"- 原始错误：{raw if raw and raw != cause else '同上'}", f"- 处理状态：`{r['status']}`", "",
        ]
    lines += [f"> 另有 {total - cap} 条未展开，请查看恢复队列。", ""] if total > cap else []
    lines += [f"[查看 GitHub Actions 运行详情]({run_url})", ""] if run_url else []
    return "\n".join([*lines, "修复后请运行 Channel Recovery，并填写渠道名和修复说明。"])


def webhook_sender(webhook: str, secret: str, post: Callable[[str, bytes], str], now: Callable[[], float], title: str = KEYWORD, sleep: Callable[[float], None] = lambda _: None, tries: int = 3) -> Callable[[str], bool]:
    """A sender for ``deliver`` that posts Markdown to a webhook by an injected request (address, body) -> answer.

    The request raises OSError if there is no connection, and is then made again after 1 and 2 seconds; an answer that
    is no JSON, or has an error code, is an error. The address is checked at once.
    """
    signed_url(webhook, secret, 0)

    def send(text: str) -> bool:
        body = json.dumps({"msgtype": "markdown", "markdown": {"title": title, "text": text}}, ensure_ascii=False).encode()
        for attempt in range(tries):
            try:
                answer = post(signed_url(webhook, secret, int(now() * 1000)), body)
                break
            except OSError as gone:
                if attempt == tries - 1:
                    raise NotificationError("no connection to the webhook") from gone
                sleep(2.0**attempt)
        try:
            result = json.loads(answer)
        except ValueError as odd:
            raise NotificationError("the webhook's answer is no JSON") from odd
        code = result.get("errcode", result.get("code", 0))
        if code not in (0, "0", None):
            raise NotificationError(f"the webhook refuses the message: {safe(code)} {safe(result.get('errmsg') or result.get('message'))}")
        return True

    return send


def message(rows: list[dict], cap: int = 30, total: int | None = None) -> str:
    """A list of incidents for a chat, at most ``cap`` of them with the number of the rest (of ``total``)."""
    total = len(rows) if total is None else total
    lines = [f"- {r['date']} {r['source']}: {r['status']}" for r in rows[:cap]]
    return "\n".join(lines + [f"- and {total - cap} more"] * (total > cap))


def deliver(changes: DataFrame, send: Callable[[str], bool], tries: int = 3, cap: int = 30, render: Callable[[list[dict], int], str] | None = None) -> bool:
    """Sends status changes by an injected sender; the caller marks them only if this is true.

    The driver reads ``cap`` rows and a count, however many changes there are.
    """
    total = changes.count()
    if not total:
        return True
    rows = [r.asDict() for r in changes.limit(cap).collect()]
    text = render(rows, total) if render else message(rows, cap, total)
    return any(send(text) for _ in range(tries))


def download_workbook(token: Callable[[], str], get: Callable[[str], bytes], least: int = 1024) -> bytes:
    """An export workbook by injected requests: a token first, then the file, which has to be a zip of some size."""
    data = get(token())
    if len(data) < least or not data.startswith(b"PK"):
        raise ValueError("the export is no workbook")
    return data
