"""Command line over stored tables.

``python -m newsloom.cli collect|cycle|reconcile|recover|notify|status|check|resolve|rollup|weekly|monthly|purge|taxonomy``
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import shlex
import subprocess
import sys
import time
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import article_date, parse_target_date, previous_period
from newsloom.operators import articles as A
from newsloom.operators import incidents, reports, rollup, taxonomy
from newsloom.plans import collect, cycle
from newsloom.plans.cycle import QUEUE, STATE, Cycle, current
from newsloom.sources import edges, fetching, files, workbooks
from newsloom.sources.files import read_articles, write_csv, write_version
from newsloom.sources.store import Store

#: Where the address and secret of the webhook are taken from.
WEBHOOK, SECRET = "NEWSLOOM_WEBHOOK", "NEWSLOOM_WEBHOOK_SECRET"
Runner = Callable[[list[str]], int]
Post = Callable[[str, bytes], str]


def post(url: str, body: bytes) -> str:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json; charset=utf-8"}, method="POST")
    with urllib.request.urlopen(request, timeout=15) as answer:  # noqa: S310  (the address has been checked)
        return answer.read().decode("utf-8", "replace")


def call(command: list[str]) -> int:
    return subprocess.run(command, check=False).returncode


def table(spark: SparkSession, path: str) -> DataFrame:
    """Articles from JSON lines, from Parquet files, or from a stored table with a log."""
    if files.exists(spark, f"{path}/_log"):
        return Store(spark, path, "_key").read()
    return read_articles(spark, path) if path.endswith((".jsonl", ".json")) else spark.read.parquet(path)


def backfill(command: str, run: Runner) -> Callable[[DataFrame], DataFrame]:
    """Runs a command for every incident under way, one after the other, with its day and channel as last arguments."""

    def fill(confirmed: DataFrame) -> DataFrame:
        outcomes = [(r["id"], run([*shlex.split(command), str(r["date"]), r["source"]]), "") for r in confirmed.select("id", "date", "source").orderBy("date", "source").toLocalIterator()]
        return confirmed.sparkSession.createDataFrame(outcomes, "id string, exit_code int, reason string")

    return fill


def notify(step: Cycle, send: Post, run_url: str = "") -> bool:
    """Sends what has changed; without a webhook nothing is sent and nothing is marked."""
    webhook = os.environ.get(WEBHOOK, "").strip()
    if not webhook:
        print(f"{WEBHOOK} is unset: no messages")
        return True
    sender = edges.webhook_sender(webhook, os.environ.get(SECRET, "").strip(), send, time.time, sleep=time.sleep)
    return step.notify(sender, lambda rows, total: edges.alert(rows, total, run_url=run_url))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="newsloom")
    sub = out.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *, home: bool = True) -> argparse.ArgumentParser:
        own = sub.add_parser(name, help=text)
        if home:
            own.add_argument("--home", required=True, help="folder of the state tables")
        return own

    for name, text in (("cycle", "audit, queue, ledger, backfill and messages of a day"), ("reconcile", "audit, queue and ledger of a day")):
        own = add(name, text)
        own.add_argument("--articles", required=True)
        own.add_argument("--health", required=True, help="health report of the day's run, as JSON")
        own.add_argument("--day", help="yyyy-mm-dd; the report's own by default")
        if name == "cycle":
            own.add_argument("--backfill", help="command that is run with a day and a channel")
            own.add_argument("--no-notify", action="store_true")
    own = add("collect", "the articles of a day from all channels, or some")
    own.add_argument("--sources", required=True, help="workbook of the channels")
    own.add_argument("--store", required=True, help="folder of the article table")
    own.add_argument("--day", help="yyyy-mm-dd; the day before by default")
    own.add_argument("--only", action="append", default=[], help="name of a channel")
    own.add_argument("--limit", type=int, default=collect.LIMIT)
    own.add_argument("--candidates", type=int, default=collect.CANDIDATES)
    own.add_argument("--delay", type=float, default=fetching.DELAY)
    own = add("recover", "backfill of confirmed incidents")
    own.add_argument("--articles", required=True)
    own.add_argument("--command", dest="with_", required=True)
    add("notify", "messages about incidents whose state has changed").add_argument("--run-url", default="")
    add("status", "channels, those that need something first").add_argument("--report", help="folder for the report as JSON and Markdown")
    add("check", "open incidents that need a person; code 1 if there are any").add_argument("--warn-only", action="store_true")
    own = add("resolve", "what a person has decided about incidents")
    own.add_argument("action", choices=["confirm", "ignore"])
    own.add_argument("ids", nargs="*")
    own.add_argument("--source")
    own.add_argument("--date", action="append", default=[])
    own.add_argument("--note", default="")
    own = add("rollup", "articles of a week or a month by day", home=False)
    own.add_argument("unit", choices=["week", "month"])
    for name in ("weekly", "monthly"):
        add(name, f"the {name} export", home=False)
    for name in ("rollup", "weekly", "monthly"):
        sub.choices[name].add_argument("--articles", required=True)
        sub.choices[name].add_argument("--out", required=True)
        sub.choices[name].add_argument("--start", type=dt.date.fromisoformat)
        sub.choices[name].add_argument("--end", type=dt.date.fromisoformat)
    own = add("purge", "articles without those that are access challenges", home=False)
    own.add_argument("--articles", required=True)
    own.add_argument("--out", required=True)
    own = add("taxonomy", "leaves of a mind map against the taxonomy", home=False)
    own.add_argument("map")
    own.add_argument("--taxonomy", required=True)
    own.add_argument("--exact", action="store_true")
    return out


def window(args: argparse.Namespace, unit: str, fail: Callable[[str], None]) -> tuple[dt.date, dt.date]:
    if (args.start is None) != (args.end is None) or args.start and args.start > args.end:
        fail("a window needs both ends, the first not after the last")
    return (args.start, args.end) if args.start else previous_period(dt.date.today(), unit)


def in_window(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    rows = table(spark, path).withColumn("summary_date", article_date(F.col("published_at"), F.col("url")))
    return rollup.in_window(rows, F.lit(first), F.lit(last))


def exported(rows: DataFrame) -> DataFrame:
    """Articles of a window, each address once, in the order of an export."""
    have = [c if c in rows.columns else F.lit("").alias(c) for c in [*reports.DETAIL, "category", "category_method"]]
    numbered = rows.select(*have, "summary_date").withColumn("_seq", F.monotonically_increasing_id())
    return A.rollup_dedup(numbered, "_seq").drop("_seq")


def main(argv: list[str] | None = None, *, run: Runner = call, send: Post = post) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    now = dt.datetime.now(dt.UTC).isoformat()
    return COMMANDS[args.command](spark, args, now, run, send)


def _cycle(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    health = files.health_rows(spark.read.schema(files.HEALTH).option("multiLine", True).option("mode", "FAILFAST").json(args.health))
    day = args.day or (health.agg(F.max("target_date")).first()[0] or "")
    if not day:
        day = parse_target_date(None, dt.datetime.now(dt.UTC)).isoformat()
    fill = backfill(args.backfill, run) if getattr(args, "backfill", None) else None
    cycle.run(spark, args.home, lambda: table(spark, args.articles), health.drop("target_date"), day, now, backfill=fill)
    if args.command == "cycle" and not args.no_notify:
        return int(not notify(Cycle(spark, args.home, day, now), send))
    return 0


def _collect(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    day = parse_target_date(args.day, dt.datetime.now(dt.UTC)).isoformat()
    sources, store = files.read_sources(spark, args.sources), Store(spark, args.store, "_key")
    try:
        health = collect.collect(spark, args.home, sources, store, fetching.http_get, day, now, only=tuple(args.only), limit=args.limit, candidate_limit=args.candidates, delay=args.delay)
    except reports.UnknownSources as unknown:
        print(unknown)
        return unknown.exit_code
    fields = [c for c in health.columns if c != "min_content_chars"]
    files.write_text(spark, f"{args.home}/channel-health.json", reports.health_report(health, F.lit(day), F.lit(now), fields).first()["report"])
    return int(not reports.unhealthy(health).isEmpty())


def _recover(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    step = Cycle(spark, args.home, now[:10], now)
    step.backfill(backfill(args.with_, run), lambda: table(spark, args.articles))
    failed = step.table("queue", QUEUE).where("status = 'recovery_failed'")
    return int("queue" in step.out and not failed.where(F.col("last_attempt_at") == now).isEmpty())


def _notify(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    try:
        return int(not notify(Cycle(spark, args.home, now[:10], now), send, args.run_url))
    except (edges.NotificationError, ValueError) as refused:
        print(edges.safe(refused))
        return 1


def _status(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    state, queue = current(spark, args.home, "state", STATE), current(spark, args.home, "queue", QUEUE)
    incidents.actionable_first(state.select("source", "last_status", "consecutive_unhealthy", "open_incidents", "next_action", "last_success_date")).show(100, False)
    if args.report:
        report = reports.operations_report(state, queue, now)
        for name, text in (("channel-ops-report.json", reports.as_json(report)), ("channel-ops-report.md", reports.operations_markdown(report))):
            files.write_text(spark, f"{args.report}/{name}", text)
    return 0


def _check(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    waiting = current(spark, args.home, "queue", QUEUE).where(F.col("status").isin("pending_confirmation", "recovery_failed"))
    total = waiting.count()
    for r in waiting.orderBy("date", "source").limit(100).collect():
        print(f"{r['date']} {r['source']}: {edges.safe(r['diagnosis'] or r['last_error'] or r['diagnosis_code'])}")
    return int(total > 0 and not args.warn_only)


def _resolve(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    queue = current(spark, args.home, "queue", QUEUE)
    named = F.col("id").isin(args.ids)
    if args.source:
        named = named | ((F.col("source") == args.source) & (F.col("date").cast("string").isin(args.date) if args.date else F.lit(True)))
    after = incidents.resolve(queue, queue.where(named).select("id"), args.action, F.lit(now))
    before = queue.select("id", F.col("status").alias("_was"))
    moved = F.col("status") != F.col("_was")
    after = after.join(before, "id").withColumn("confirmation_note", F.when(moved, args.note).otherwise(F.col("confirmation_note")))
    after = after.withColumn("confirmed_at", F.when(moved & (F.col("status") == "confirmed"), now).otherwise(F.col("confirmed_at")))
    if after.where(moved).isEmpty():
        return 1
    write_version(after.select(queue.columns), f"{args.home}/queue", args.action)
    Cycle(spark, args.home, now[:10], now).fold(current(spark, args.home, "queue", QUEUE))
    return 0


def _rollup(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    rows = in_window(spark, args.articles, *window(args, args.unit, parser().error))
    write_csv(rollup.detail(rows), f"{args.out}/articles", reports.DETAIL)
    write_csv(rollup.by_day(rows), f"{args.out}/by_day", ["summary_date", "article_count"])
    return 0


def _weekly(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    first, last = window(args, "week", parser().error)
    write_csv(rollup.detail(exported(in_window(spark, args.articles, first, last))), f"{args.out}/{reports.week_name(last)}", reports.DETAIL)
    return 0


def _monthly(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    first, last = window(args, "month", parser().error)
    os.makedirs(args.out, exist_ok=True)
    path = os.path.join(args.out, f"articles_month_{first:%Y-%m}.xlsx")
    with open(path + ".part", "wb") as target:
        counts = workbooks.write_frames(reports.monthly_sheets(exported(in_window(spark, args.articles, first, last))), target)
    os.replace(path + ".part", path)
    print(f"{path}: {counts['Articles']} articles from {first} to {last}")
    return 0


def _purge(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    files.purge_challenges(table(spark, args.articles)).write.mode("error").json(args.out)
    return 0


def _taxonomy(spark: SparkSession, args: argparse.Namespace, now: str, run: Runner, send: Post) -> int:
    found, allowed = taxonomy.read_leaves(spark, args.map), taxonomy.read_taxonomy(spark, args.taxonomy)
    for r in taxonomy.compare(found, allowed).orderBy("kind", "path").toLocalIterator():
        print(f"{r['kind'].upper()}: {r['path']}")
    return taxonomy.verify(found, allowed, exact=args.exact)


COMMANDS = {
    "collect": _collect, "cycle": _cycle, "reconcile": _cycle, "recover": _recover, "notify": _notify, "status": _status, "check": _check, "resolve": _resolve, "rollup": _rollup, "weekly": _weekly, "monthly": _monthly, "purge": _purge, "taxonomy": _taxonomy,
}

if __name__ == "__main__":
    sys.exit(main())
