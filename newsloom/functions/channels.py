"""Rules about channels: whether they are skipped, when they are expected to publish, what their failures mean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import present, strip

#: Fixed values.
SKIP_NOTES = ["公众号", "无法访问", "需邮箱订阅", "邮箱订阅", "需账号登录", "不适合"]
LOW_FREQUENCY = ["周", "月", "季度", "低频", "weekly", "monthly", "quarterly"]
WEEKDAYS_ONLY = ["工作日", "weekday", "business day"]
UNHEALTHY = ["failed", "zero", "degraded"]
SUCCESS = ["healthy", "already_collected", "idle", "recovered", "verified_no_news"]
OPEN = ["pending_confirmation", "confirmed", "recovering", "recovery_failed"]
#: Diagnoses of failed crawls: the first group with a needle in the reason decides.
DIAGNOSES = [
    (["missing run record"], "missing_run_record"),
    (["401", "unauthorized", "authentication", "authenticated subscriber"], "authentication_failed"),
    (["403", "forbidden"], "access_denied"),
    (["404", "not found"], "entry_not_found"),
    (["429", "too many requests"], "rate_limited"),
    (["500", "502", "503", "504", "service unavailable", "bad gateway"], "upstream_unavailable"),
    (["timeout", "timed out"], "timeout"),
    (["ssl", "certificate"], "tls_error"),
    (["robots"], "robots_blocked"),
    (["name resolution", "dns"], "dns_error"),
    (["parse", "selector"], "parser_error"),
]

#: What a person reads for a code.
DIAGNOSIS_TEXTS = {
    "missing_run_record": "该日期没有渠道抓取记录，检查工作流延迟、取消或进程级失败",
    "authentication_failed": "认证失败或订阅 Feed 不可用，检查账号权限和 GitHub Actions Secrets",
    "access_denied": "站点拒绝访问（HTTP 403），检查反爬、请求头或访问权限",
    "entry_not_found": "抓取入口返回 HTTP 404，检查渠道 URL 或 RSS 地址",
    "rate_limited": "请求频率受限（HTTP 429），降低频率或增加重试退避",
    "upstream_unavailable": "站点服务暂时不可用（HTTP 5xx），保留缺口并在站点恢复后验证",
    "timeout": "站点请求超时，检查可用性并调整超时/重试策略",
    "tls_error": "TLS/证书校验失败，检查站点证书或网络链路",
    "robots_blocked": "robots.txt 禁止抓取，需确认合规抓取入口",
    "dns_error": "域名解析失败，检查域名是否失效或网络 DNS",
    "parser_error": "页面解析失败，检查列表或正文选择器是否已变更",
    "no_candidates": "未发现任何候选文章，优先检查列表/RSS 地址、页面结构、选择器或站点可达性",
    "candidates_filtered": "发现候选但未抓取正文，可能全部被日期过滤、URL 去重或候选日期解析错误",
    "no_target_articles": "已访问候选正文但目标日期仍为零，检查发布日期解析、正文解析及站点是否确实无更新",
}


def contains_any(c: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def skip_reason(note: Column, url: Column) -> Column:
    """Why a channel is skipped: the first keyword in its note, or that it has no address; null if it is not."""
    out = F.when(present(url) == "", F.lit("链接为空"))
    for word in reversed(SKIP_NOTES):
        out = F.when(strip(present(note)).contains(word), F.lit(f"备注包含“{word}”")).otherwise(out)
    return out


def expects_daily(frequency: Column) -> Column:
    return ~contains_any(F.lower(strip(present(frequency))), LOW_FREQUENCY)


def expects_on(frequency: Column, day: Column) -> Column:
    """Whether a channel is expected to publish on a day: daily ones always, weekday ones from Monday to Friday."""
    return expects_daily(frequency) & (~contains_any(F.lower(strip(present(frequency))), WEEKDAYS_ONLY) | (F.weekday(day) < 5))


def diagnosis(crawl_status: Column, reason: Column, candidates: Column, pages: Column) -> Column:
    """Code of what kept a channel from delivering."""
    low, out = F.lower(present(reason)), F.lit("fetch_failed")
    for needles, code in reversed(DIAGNOSES):
        out = F.when(contains_any(low, needles), code).otherwise(out)
    quiet = F.when(F.coalesce(candidates, F.lit(0)) == 0, "no_candidates").when(F.coalesce(pages, F.lit(0)) == 0, "candidates_filtered").otherwise("no_target_articles")
    return F.when(crawl_status == "failed", out).otherwise(quiet)


def diagnosis_text(code: Column, reason: Column) -> Column:
    """The sentence for a code; a failure that no rule knows quotes its reason."""
    known = F.try_element_at(F.create_map(*(F.lit(x) for kv in DIAGNOSIS_TEXTS.items() for x in kv)), code)
    quoted = F.concat(F.lit("抓取任务异常退出："), F.coalesce(F.nullif(present(reason), F.lit("")), F.lit("未记录底层错误")))
    return F.when(code == "fetch_failed", quoted).otherwise(known)


def next_action(status: Column, incidents: Column) -> Column:
    """What is to be done about a channel, from its status and the set of its open incidents' statuses."""
    has = lambda *names: reduce(lambda a, b: a | b, [F.array_contains(incidents, n) for n in names])
    return (
        F.when(has("recovery_failed"), "repair_then_reconfirm")
        .when(has("confirmed", "recovering"), "automatic_backfill")
        .when(has("pending_confirmation"), "repair_then_confirm")
        .when(status.isin(UNHEALTHY), "investigate")
        .otherwise("none")
    )
