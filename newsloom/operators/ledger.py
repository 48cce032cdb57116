"""The ledger of events and what it folds to.

Every attempt at a channel and every run that is missing is an event with a number. Channel state is never edited: it is
the fold of a channel's events in their order. The fold is by partial aggregates (a summary of some events can be
joined to a stored state), so a ledger is replayed in one batch, continued run by run, or followed as a stream, with
the same result, and no task needs all events of a channel at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.channels import OPEN, SUCCESS, UNHEALTHY, next_action
from newsloom.functions.text import present, redact
from newsloom.operators.incidents import attempt_id, padded, settled

#: Counts of a run's health that an event carries.
COUNTS = ["candidates_seen", "pages_fetched", "new_articles", "refreshed_articles", "usable_articles", "incomplete_articles", "short_articles", "min_content_chars", "content_chars_min", "content_chars_median", "content_chars_max"]
EVENT = "id string, seq long, recorded_at string, attempted_at string, date date, source string, frequency string, status string, reason string, error_type string, crawl_mode string, " + ", ".join(f"{c} long" for c in COUNTS)
CHANNEL = (
    "source string, frequency string, last_target_date date, last_status string, previous_status string, last_attempt_at string, last_success_at string, last_success_date date, "
    "consecutive_unhealthy long, last_error_type string, last_error string, crawl_mode string, " + ", ".join(f"{c} long" for c in COUNTS) + ", seq long"
)
#: What an event of a missing run says of itself, and what settled incidents say of a day.
MISSING, MISSING_ERROR = "missing_run", "MissingRunRecord"
MISSING_REASON = "missing run record: 该日期没有渠道抓取记录，可能是工作流延迟、取消或进程级失败"
SETTLED = {"recovered": "历史缺口补抓已验证成功", "verified_no_news": "人工确认目标日期无新闻"}
#: Ids that a ledger remembers; an attempt that comes again later than that counts as new.
KEEPS = 10_000


def missing_events(gaps: DataFrame, now: Column) -> DataFrame:
    """Events of days without a run (``date, source, frequency``); the id depends on day and channel alone."""
    rows = gaps.select(
        attempt_id(F.lit(MISSING), F.col("date"), F.col("source")).alias("id"), now.alias("recorded_at"), F.lit("").alias("attempted_at"), "date", "source", "frequency",
        F.lit(MISSING).alias("status"), F.lit(MISSING_REASON).alias("reason"), F.lit(MISSING_ERROR).alias("error_type"), F.lit("scheduled").alias("crawl_mode"), *(F.lit(0).cast("long").alias(c) for c in COUNTS),
    )
    return rows.withColumn("seq", F.lit(None).cast("long"))


def attempt_events(health: DataFrame, queue: DataFrame, now: Column) -> DataFrame:
    """Events of a run's health rows (``date`` and at least ``source, status``), secrets redacted.

    An unhealthy day whose incident is closed takes the closed incident's word. The id is made of the time of the run,
    the day, the channel, its status, reason and number of new articles: a report that is read again adds no event.
    """
    rows = padded(health.where(present("source") != ""), EVENT + ", generated_at string")
    rows = rows.withColumn("status", F.coalesce(F.nullif("status", F.lit("")), F.lit("unknown")))
    rows = settled(rows.withColumn("_told", F.col("status")), queue)
    words = F.try_element_at(F.create_map(*(F.lit(x) for kv in SETTLED.items() for x in kv)), F.col("status"))
    said = F.when(F.col("status") != F.col("_told"), words).otherwise(present("reason"))
    rows = rows.withColumn("reason", F.substring(said, 1, 2000)).drop("_told")
    rows = rows.withColumn("error_type", F.substring(redact(present("error_type")), 1, 2000)).withColumn("crawl_mode", present("crawl_mode")).fillna(0, COUNTS)
    key = attempt_id(present("generated_at"), F.col("date"), F.col("source"), F.col("status"), F.col("reason"), F.col("new_articles"))
    return rows.withColumn("id", key).withColumn("recorded_at", now).withColumn("attempted_at", F.coalesce(F.nullif("generated_at", F.lit("")), now)).select(*(c.split()[0] for c in EVENT.split(", ")))


def append(events: DataFrame, seen: DataFrame, last: int) -> DataFrame:
    """Events that are not among the remembered ids, numbered on from ``last`` by day, kind, channel and id.

    Events of one run are as many as channels and gaps, so one window orders them; the ledger itself is not read.
    """
    fresh = events.dropDuplicates(["id"]).join(seen.select("id"), "id", "left_anti")
    order = Window.orderBy(F.col("status") != MISSING, "date", "source", "id")
    return fresh.withColumn("seq", F.lit(last) + F.row_number().over(order)).select(*(c.split()[0] for c in EVENT.split(", ")))


def remember(seen: DataFrame, fresh: DataFrame, keeps: int = KEEPS) -> DataFrame:
    """``id, seq`` of the last ``keeps`` events; older ones are forgotten, as the ledger itself is not."""
    return seen.select("id", "seq").unionByName(fresh.select("id", "seq")).orderBy(F.col("seq").desc()).limit(keeps)


def summary(events: DataFrame) -> DataFrame:
    """What the attempts of each channel come to: the last of them, the last frequency that one names, the last success,
    the status before the last, how many unhealthy ones stand at the end (``tail``), and whether that is all of them.

    Two rounds of partial aggregates: where the last healthy and the very last event stand, then counts behind them.
    Missing runs are no attempts and change no state. Equal numbers of one channel do not occur in a ledger.
    """
    rows = events.where((F.col("status") != MISSING) & (F.col("source") != ""))
    bad = F.col("status").isin(UNHEALTHY)
    marks = rows.groupBy("source").agg(F.max("seq").alias("_last"), F.max(F.when(~bad, F.col("seq"))).alias("_healthy"))
    both = rows.join(marks, "source")
    return both.groupBy("source").agg(
        F.max_by(F.struct(*(c for c in rows.columns if c != "source")), F.col("seq")).alias("last"),
        F.max_by("frequency", F.when(F.col("frequency") != "", F.col("seq"))).alias("frequency"),
        F.max_by(F.struct("attempted_at", "date"), F.when(F.col("status").isin(SUCCESS), F.col("seq"))).alias("success"),
        F.max_by("status", F.when(F.col("seq") < F.col("_last"), F.col("seq"))).alias("before"),
        F.sum((F.col("seq") > F.coalesce("_healthy", F.lit(-1))).cast("long")).alias("tail"),
        F.max(F.col("_healthy")).isNull().alias("all_bad"),
    )


def advance(state: DataFrame, events: DataFrame) -> DataFrame:
    """Channel state after further events; channels without one stay as they are. Events that the state has already
    taken in (by their number) are passed over, so a batch that comes again changes nothing."""
    known = padded(state, CHANNEL)
    fresh = events.join(known.select("source", F.col("seq").alias("_at")), "source", "left").where(F.coalesce(F.col("seq") > F.col("_at"), F.lit(True))).drop("_at")
    both = known.alias("p").join(summary(fresh).alias("n"), "source", "full_outer")
    new = F.col("n.last").isNotNull()
    streak = F.col("n.tail") + F.when(F.col("n.all_bad"), F.coalesce("p.consecutive_unhealthy", F.lit(0))).otherwise(0)
    taken = {"last_target_date": "date", "last_status": "status", "last_attempt_at": "attempted_at", "last_error_type": "error_type", "last_error": "reason"}
    out = {c: F.when(new, F.col(f"n.last.{taken.get(c, c)}")).otherwise(F.col(f"p.{c}")) for c in ("last_target_date", "last_status", "last_attempt_at", "last_error_type", "last_error", "crawl_mode", *COUNTS, "seq")}
    out["frequency"] = F.coalesce("n.frequency", "p.frequency", F.lit(""))
    out["previous_status"] = F.when(new, F.coalesce("n.before", present("p.last_status"))).otherwise(present("p.previous_status"))
    out["last_success_at"] = F.coalesce("n.success.attempted_at", "p.last_success_at")
    out["last_success_date"] = F.coalesce("n.success.date", "p.last_success_date")
    out["consecutive_unhealthy"] = F.when(new, streak).otherwise(F.col("p.consecutive_unhealthy")).cast("long")
    return both.select("source", *(out[c.split()[0]].alias(c.split()[0]) for c in CHANNEL.split(", ")[1:]))


def replay(events: DataFrame) -> DataFrame:
    """Channel state from the whole ledger."""
    return advance(events.sparkSession.createDataFrame([], CHANNEL), events)


def with_incidents(state: DataFrame, queue: DataFrame) -> DataFrame:
    """State with the number of open incidents of each channel and what is to be done next."""
    opened = queue.where(F.col("status").isin(OPEN)).groupBy("source").agg(F.count("*").alias("open_incidents"), F.collect_set("status").alias("_states"))  # a few statuses
    rows = state.drop("open_incidents", "next_action").join(opened, "source", "left").withColumn("_states", F.coalesce("_states", F.array().cast("array<string>")))
    return rows.withColumn("open_incidents", F.coalesce("open_incidents", F.lit(0).cast("long"))).withColumn("next_action", next_action(F.col("last_status"), F.col("_states"))).drop("_states")
