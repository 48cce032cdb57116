"""Runs and reports: content statistics of a run, its health and error records, audit and operations reports, sheets.

Counting is done on frames. What a person reads is rendered on the driver from rows whose number is bounded: channels
that need attention, open incidents, days of a month.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.channels import OPEN, UNHEALTHY
from newsloom.functions.text import present, strip
from newsloom.operators import incidents, rollup

#: Order of severity, columns of a detail sheet, and attempts that a ledger remembers.
SEVERITY = {"critical": 2, "warning": 1, "normal": 0}
DETAIL = ["title", "published_at", "content", "url", "source_name", "domain", "sub_domain"]
LEDGER_KEEPS = 10_000


class UnknownSources(ValueError):
    """Channels that were asked for by name and are not there; a command line ends with code 2."""

    exit_code = 2


def content_stats(articles: DataFrame, by: str = "source_name", *, short: int = 500) -> DataFrame:
    """Counts and lengths of the texts of a run, a row for each channel: articles, full ones, others, short ones, and
    least, median (rounded down) and greatest number of characters. Statuses are read in any case."""
    chars = F.length(strip(present("content")))
    full = F.lower(strip(present("content_status"))) == "full"
    count = lambda holds: F.sum(F.when(holds, 1).otherwise(0)).cast("long")
    return articles.groupBy(by).agg(
        F.count("*").alias("articles"), count(full).alias("usable_articles"), count(~full).alias("incomplete_articles"), count(chars < short).alias("short_articles"),
        F.min(chars).cast("long").alias("content_chars_min"), F.floor(F.percentile(chars, F.lit(0.5))).alias("content_chars_median"), F.max(chars).cast("long").alias("content_chars_max"),
    )


def most_articles(stats: DataFrame) -> DataFrame:
    """The greatest count that any row of a channel's day has."""
    return stats.where("source <> '' AND date IS NOT NULL").groupBy("source", "date").agg(F.max("article_count").alias("article_count"))


def audited_days(summary: DataFrame, latest: Column) -> DataFrame:
    """Days up to ``latest`` that an audit with configured channels covers; none at all unless ``latest`` is one."""
    days = summary.where(F.col("sources_configured") > 0).where(F.col("date") <= latest).select("date").distinct()
    return days.join(days.where(F.col("date") == latest).select(F.lit(1).alias("_there")).limit(1), how="cross").drop("_there")  # one row or none


def only_sources(sources: DataFrame, names: Iterable[str], name: str = "name") -> DataFrame:
    """Channels of the given names; names without a channel raise UnknownSources before anything runs."""
    wanted = sorted(set(names))
    kept = sources.where(F.col(name).isin(wanted))
    found = {r[0] for r in kept.select(name).distinct().collect()}  # as many as names at most
    if missing := [n for n in wanted if n not in found]:
        raise UnknownSources(f"no channel is called {', '.join(missing)}")
    return kept


def candidates_of(listed: DataFrame, candidate_limit: int, limit_per_source: int) -> DataFrame:
    """Ranked links of each channel (``rank`` from 1) up to the larger of the two limits."""
    return listed.where(F.col("rank") <= max(candidate_limit, limit_per_source))


def by_severity(rows: DataFrame, level: str = "anomaly_level", source: str = "source") -> DataFrame:
    """Rows that are not normal, the most severe first, then by channel."""
    rank = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv)), F.col(level)), F.lit(0))
    return rows.where(present(level) != "normal").orderBy(rank.desc(), source)


def remember(ledger: DataFrame, fresh: DataFrame, order: list[Column], keeps: int = LEDGER_KEEPS) -> DataFrame:
    """Ids that later runs count as seen: the last ``keeps`` of stored and fresh attempts in their order."""
    every = ledger.unionByName(fresh.join(ledger.select("id"), "id", "left_anti"))
    return every.orderBy(*[o.desc() for o in order]).limit(keeps)


def error_records(failures: DataFrame, day: Column, now: Column) -> DataFrame:
    """Failures of channels as records of the error ledger, which is appended to as JSON lines."""
    return failures.select(now.cast("string").alias("occurred_at"), day.cast("string").alias("target_date"), present("source").alias("source"), present("url").alias("url"), present("error_type").alias("error_type"), present("error").alias("error"))


def health_report(health: DataFrame, day: Column, now: Column, fields: list[str]) -> DataFrame:
    """One row with the JSON text of a run's health: its channels by name, which are as many as are configured."""
    rows = F.array_sort(F.collect_list(F.struct(*fields)))
    return health.agg(F.to_json(F.struct(now.cast("string").alias("generated_at"), day.cast("string").alias("target_date"), rows.alias("sources"))).alias("report"))


def cell(value: object) -> str:
    """A value in a table of Markdown."""
    return "-" if value is None or value == "" else str(value).replace("|", "\\|").replace("\n", " ")


def table(header: list[str], rows: list[list], none: str) -> list[str]:
    body = [f"| {' | '.join(map(cell, r))} |" for r in rows] or [f"| {' | '.join([none, *['-'] * (len(header) - 1)])} |"]
    return [f"| {' | '.join(header)} |", f"|{'---|' * len(header)}", *body]


def operations_report(state: DataFrame, queue: DataFrame, now: str) -> dict:
    """Totals, channels (those that need something first) and open incidents, as a value that JSON can hold."""
    totals = incidents.report(state, queue).first().asDict()
    by_status = {r["s"]: r["n"] for r in state.groupBy(F.coalesce(F.nullif("last_status", F.lit("")), F.lit("unknown")).alias("s")).agg(F.count("*").alias("n")).orderBy("s").collect()}
    channels = [r.asDict() for r in incidents.actionable_first(state).collect()]  # as many as are configured
    open_ = [r.asDict() for r in queue.where(F.col("status").isin(OPEN)).orderBy("date", "source").collect()]
    return {"generated_at": now, "summary": totals | {"status_counts": by_status}, "channels": channels, "incidents": open_}


def operations_markdown(report: dict) -> str:
    """The operations report as Markdown. Its headings and the headers of its table."""
    s = report["summary"]
    todo = [[c["source"], c["last_status"], c["consecutive_unhealthy"], c["open_incidents"], c["next_action"]] for c in report["channels"] if c["next_action"] != "none"]
    lines = ["# 渠道运维总览", "", f"- 生成时间：{report['generated_at']}", f"- 渠道数：{s['channels']}", f"- 健康/正常空闲：{s['healthy']}", f"- 异常渠道：{s['unhealthy']}", f"- 待处理缺口：{s['open_incidents']}", "", "## 需要处理的渠道", ""]
    return "\n".join([*lines, *table(["渠道", "状态", "连续异常", "待补日期数", "下一步"], todo, "无待处理异常"), ""])


def audit_report(judged: DataFrame, summary: DataFrame, queue: DataFrame, day: dt.date) -> dict:
    """The audit of one day: its totals, the channels that stand out, and the open incidents."""
    total = summary.where(F.col("date") == F.lit(day)).first()
    odd = [r.asDict() for r in by_severity(judged.where(F.col("date") == F.lit(day))).collect()]  # as many as are configured
    open_ = [r.asDict() for r in queue.where(F.col("status").isin(OPEN)).orderBy("date", "source").collect()]
    return {"target_date": day.isoformat(), "summary": total.asDict() if total else {}, "channels": odd, "incidents": open_}


def audit_markdown(report: dict) -> str:
    """The audit of a day as Markdown. Its headings and the headers of its tables."""
    s = report["summary"]
    odd = [[c["anomaly_level"], c["source"], c["article_count"], c.get("previous_count"), c.get("baseline_median_7d"), c.get("zero_streak_days"), c.get("anomaly_codes")] for c in report["channels"]]
    open_ = [[i["status"], i["date"], i["source"], i["diagnosis_code"]] for i in report["incidents"]]
    lines = ["# 新闻渠道自主审查报告", "", f"- 审查日期：{report['target_date']}", f"- 整体状态：{s.get('anomaly_level') or 'normal'}", f"- 收集总量：{s.get('total_articles') or 0} 篇", f"- 正文可用：{s.get('usable_articles') or 0} 篇", "", "## 渠道异常", ""]
    lines += [*table(["级别", "渠道", "今日", "前次", "7日中位数", "连续为0", "异常说明"], odd, "normal"), "", "## 自反馈恢复队列", ""]
    return "\n".join([*lines, *table(["状态", "缺失日期", "渠道", "原因判断"], open_, "当前没有待处理的渠道缺口"), ""])


def as_json(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2, default=str)


def monthly_sheets(rows: DataFrame) -> dict[str, DataFrame]:
    """The five sheets of a month's roll-up, by name."""
    return {
        "Articles": rollup.detail(rows).select(*DETAIL),
        "Source Summary": rollup.by_source(rows),
        "Domain Summary": rollup.by_keys(rows, "domain", "sub_domain"),
        "Daily Summary": rollup.by_day(rows),
        "Category Placeholder": rollup.by_keys(rows, "category", "category_method"),
    }


def week_name(last: dt.date) -> str:
    """What a weekly export is called, by the ISO week of its last day."""
    year, week, _ = last.isocalendar()
    return f"articles_week_{year}-W{week:02d}.csv"


def first_that_has_rows(sources: Iterable[Callable[[], DataFrame]]) -> DataFrame | None:
    """The first of several ways to get a channel's articles that gives any: a stored workbook before its public pages."""
    for read in sources:
        rows = read()
        if not rows.isEmpty():
            return rows
    return None


def with_required_day(rows: DataFrame, date: str, required: Column) -> DataFrame:
    """Days of an export with their number of rows; the required one is there even if it has none."""
    days = rows.where(F.col(date).isNotNull()).groupBy(F.col(date).alias("date")).agg(F.count("*").alias("rows"))
    asked = rows.sparkSession.range(1).select(required.cast("date").alias("date"))
    return days.unionByName(asked.join(days, "date", "left_anti").select("date", F.lit(0).cast("long").alias("rows")))


def unhealthy(health: DataFrame) -> DataFrame:
    """Channels of a run that failed or fell short, for the error ledger and the run's exit code."""
    return health.where(F.col("status").isin(UNHEALTHY))
