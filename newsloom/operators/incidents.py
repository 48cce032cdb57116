"""Incidents: the recovery queue, channel state, the event ledger and notifications, as batch merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.channels import OPEN, SUCCESS, UNHEALTHY, diagnosis, diagnosis_text, next_action
from newsloom.functions.text import present, redact

#: States that are worth a message, and what the system notes where it confirms an incident itself.
NOTIFIABLE = ["pending_confirmation", "recovery_failed", "recovered"]
AUTO_NOTE = "系统检测到整日运行记录缺失，自动确认补抓"
STILL_EMPTY = "补抓完成但目标日期仍无文章"
#: An incident as it is stored.
INCIDENT = (
    "id string, date date, source string, frequency string, status string, detected_at string, confirmed_at string, confirmation_note string, attempts long, last_attempt_at string, "
    "recovered_articles long, recovered_at string, anomaly_level string, anomaly_codes string, crawl_status string, crawl_mode string, candidates_seen long, pages_fetched long, "
    "diagnosis_code string, diagnosis string, technical_reason string, error_type string, failed_at string, last_error string, updated_at string"
)
#: What a day's reasons may tell.
REASON = "source string, date date, reason string, candidates_seen long, pages_fetched long, crawl_mode string, error_type string, failed_at string"
CELL = "date date, source string, frequency string, crawl_status string, article_count long, expected_daily boolean, anomaly_level string, anomaly_codes string"


def incident_id(day: Column, source: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("::"), source)


def padded(rows: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema in its order and types; absent ones are null, others are left out."""
    have = set(rows.columns)
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return rows.select(*((F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in fields))


def sync_days(cells: DataFrame, queue: DataFrame, reasons: DataFrame, now: Column) -> DataFrame:
    """The whole queue (``INCIDENT``) after statistics of some days (``CELL``) and what is known of them (``REASON``).

    Open incidents of days that have articles now are recovered, however old the day is. Expected days that are zero
    or failed open an incident, or refresh the diagnosis of the one they have; closed ones are never opened again.
    Reasons belong to a channel's day: a gap is diagnosed by its own, not by that of a later run.
    """
    s = padded(cells.where("source <> '' AND date IS NOT NULL"), CELL).withColumn("id", incident_id(F.col("date"), F.col("source")))
    s = s.join(padded(reasons, REASON).withColumnsRenamed({"crawl_mode": "h_mode", "reason": "h_reason"}), ["source", "date"], "left").alias("s")
    both = s.join(padded(queue, INCIDENT).alias("q"), F.col("s.id") == F.col("q.id"), "full_outer")
    here, known = F.col("s.id").isNotNull(), F.col("q.id").isNotNull()
    filled = here & (F.col("s.article_count") > 0)
    bad = F.coalesce(here & ~filled & F.col("s.expected_daily") & F.col("s.crawl_status").isin("zero", "failed"), F.lit(False))
    recovered = F.coalesce(known & filled & F.col("q.status").isin(OPEN), F.lit(False))
    code = diagnosis(F.col("s.crawl_status"), F.col("h_reason"), F.col("s.candidates_seen"), F.col("s.pages_fetched"))
    zero, blank = F.lit(0).cast("long"), F.lit("")
    fresh = {
        "anomaly_level": F.coalesce("s.anomaly_level", F.lit("warning")), "anomaly_codes": present("s.anomaly_codes"), "crawl_status": F.col("s.crawl_status"), "crawl_mode": present("h_mode"),
        "candidates_seen": F.coalesce("s.candidates_seen", zero), "pages_fetched": F.coalesce("s.pages_fetched", zero), "diagnosis_code": code, "diagnosis": diagnosis_text(code, F.col("h_reason")),
        "technical_reason": present("h_reason"), "error_type": present("s.error_type"), "failed_at": present("s.failed_at"),
    }
    out = {c: F.when(bad, v).otherwise(F.col(f"q.{c}")) for c, v in fresh.items()}
    out |= {c: F.coalesce(f"q.{c}", f"s.{c}") for c in ("id", "date", "source")}
    out |= {c: F.coalesce(f"q.{c}", blank) for c in ("confirmed_at", "confirmation_note", "last_attempt_at", "last_error")}
    out["frequency"] = F.coalesce("q.frequency", present("s.frequency"))
    out["detected_at"] = F.when(known, F.col("q.detected_at")).otherwise(now)
    out["attempts"] = F.coalesce("q.attempts", zero)
    out["status"] = F.when(recovered, "recovered").when(known, F.col("q.status")).otherwise("pending_confirmation")
    out["recovered_articles"] = F.when(recovered, F.col("s.article_count")).otherwise(F.coalesce("q.recovered_articles", zero))
    out["recovered_at"] = F.when(recovered, now).otherwise(F.coalesce("q.recovered_at", blank))
    out["updated_at"] = F.when(bad | recovered, now).otherwise(F.col("q.updated_at"))
    return both.where(known | bad).select(*(out[f.rsplit(" ", 1)[0]].alias(f.rsplit(" ", 1)[0]) for f in INCIDENT.split(", ")))


def sync(stats: DataFrame, queue: DataFrame, health: DataFrame, now: Column) -> DataFrame:
    """``sync_days`` for statistics of any days, each with the reason of its channel's only health row."""
    h = health.select("source", "reason", "candidates_seen", "pages_fetched")
    reasons = stats.select("source", "date").distinct().join(h, "source")
    return sync_days(stats, queue, reasons, now).select("id", "date", "source", "status", "attempts", "recovered_articles", "diagnosis_code", "updated_at")


def resolve(queue: DataFrame, ids: list[str] | DataFrame, action: str, now: Column) -> DataFrame:
    """``confirm`` moves pending and failed incidents to confirmed, ``ignore`` any open one to ignored.

    ``ids`` are those that a person has typed, or a frame with a column ``id``, which is joined and never collected.
    """
    allowed = ["pending_confirmation", "recovery_failed"] if action == "confirm" else OPEN
    if isinstance(ids, DataFrame):
        rows = queue.join(ids.select("id").distinct().withColumn("_named", F.lit(True)), "id", "left")
        named = F.coalesce("_named", F.lit(False))
    else:
        rows, named = queue, F.col("id").isin(ids)
    hit = named & F.col("status").isin(allowed)
    moved = {"updated_at": F.when(hit, now).otherwise(F.col("updated_at")), "status": F.when(hit, "confirmed" if action == "confirm" else "ignored").otherwise(F.col("status"))}
    return rows.select(*(moved[c].alias(c) if c in moved else F.col(c) for c in queue.columns))


def auto_confirm(queue: DataFrame, now: Column | None = None) -> DataFrame:
    """Pending incidents of missing runs are confirmed without a person."""
    hit = (F.col("status") == "pending_confirmation") & (F.col("diagnosis_code") == "missing_run_record")
    moved = {"status": F.lit("confirmed")} | ({} if now is None else {"confirmed_at": now, "confirmation_note": F.lit(AUTO_NOTE), "updated_at": now})
    return queue.select(*(F.when(hit, moved[c]).otherwise(F.col(c)).alias(c) if c in moved else F.col(c) for c in queue.columns))


def begin_recovery(queue: DataFrame, now: Column) -> DataFrame:
    """First step of a backfill: confirmed incidents, and those that an earlier one left behind, are under way.

    The result is stored before anything is fetched, so an attempt that dies is counted and taken up again.
    """
    hit = F.col("status").isin("confirmed", "recovering")
    moved = {"status": F.lit("recovering"), "attempts": F.col("attempts") + 1, "last_attempt_at": now, "updated_at": now}
    return queue.select(*(F.when(hit, moved[c]).otherwise(F.col(c)).alias(c) if c in moved else F.col(c) for c in queue.columns))


def end_recovery(queue: DataFrame, inventory: DataFrame, now: Column, outcomes: DataFrame | None = None) -> DataFrame:
    """Second step, over the inventory as it is after the backfill: incidents under way are recovered if their day has
    articles and the backfill reports no error, else failed, with what it says (``outcomes``: ``id, exit_code, reason``).
    """
    found = inventory.groupBy(incident_id(F.col("date"), F.col("source")).alias("id")).agg(F.max("article_count").alias("_n"))
    rows = queue.join(found, "id", "left")
    if outcomes is None:
        rows = rows.withColumn("_code", F.lit(0)).withColumn("_said", F.lit(""))
    else:
        told = outcomes.groupBy("id").agg(F.max(F.struct(F.coalesce("exit_code", F.lit(0)).alias("c"), present("reason").alias("r"))).alias("_o"))
        rows = rows.join(told, "id", "left").withColumn("_code", F.coalesce("_o.c", F.lit(0))).withColumn("_said", present("_o.r")).drop("_o")
    tried, n = F.col("status") == "recovering", F.coalesce("_n", F.lit(0).cast("long"))
    done = (n > 0) & (F.col("_code") == 0)
    error = F.when(F.col("_said") != "", F.col("_said")).when(F.col("_code") != 0, F.concat(F.lit("补抓命令退出码为 "), F.col("_code").cast("string"))).otherwise(STILL_EMPTY)
    moved = {
        "status": F.when(done, "recovered").otherwise("recovery_failed"), "recovered_articles": F.when(done, n).otherwise(F.col("recovered_articles")),
        "recovered_at": F.when(done, now).otherwise(F.col("recovered_at")), "last_error": F.when(done, "").otherwise(error), "updated_at": now,
    }
    return rows.select(*(F.when(tried, moved[c]).otherwise(F.col(c)).alias(c) if c in moved else F.col(c) for c in queue.columns))


def finish(queue: DataFrame, inventory: DataFrame) -> DataFrame:
    """Confirmed incidents after a backfill: recovered if their day has articles now, else failed; one attempt more.
    All incidents are counted in one join."""
    found = inventory.select(incident_id(F.col("date"), F.col("source")).alias("id"), F.col("article_count").alias("_n"))
    rows = queue.join(found, "id", "left")
    tried, n = F.col("status") == "confirmed", F.coalesce("_n", F.lit(0).cast("long"))
    rows = rows.withColumn("attempts", F.col("attempts") + F.when(tried, 1).otherwise(0)).withColumn("recovered_articles", F.when(tried, n).otherwise(F.col("recovered_articles")))
    return rows.withColumn("status", F.when(tried, F.when(n > 0, "recovered").otherwise("recovery_failed")).otherwise(F.col("status"))).drop("_n")


def attempt_id(*parts: Column) -> Column:
    """The first 24 hex digits of the SHA-256 of parts in lines."""
    return F.substring(F.sha2(F.concat_ws("\n", *(present(p.cast("string")) for p in parts)), 256), 1, 24)


def settled(health: DataFrame, queue: DataFrame) -> DataFrame:
    """Health rows whose incident has been recovered or ignored say so."""
    rows = health.join(queue.select("source", "date", F.col("status").alias("_incident")), ["source", "date"], "left")
    bad = F.col("status").isin(UNHEALTHY)
    status = F.when(bad & (F.col("_incident") == "recovered"), "recovered").when(bad & (F.col("_incident") == "ignored"), "verified_no_news").otherwise(F.col("status"))
    return rows.withColumn("status", status).withColumn("reason", redact(F.col("reason"))).drop("_incident")


def new_events(health: DataFrame, seen: DataFrame, id_: str = "id") -> DataFrame:
    """Attempts that the ledger does not hold yet."""
    return health.join(seen.select(id_), id_, "left_anti")


def channel_state(previous: DataFrame, events: DataFrame, queue: DataFrame) -> DataFrame:
    """Each channel after a run's new events, one per channel: status, streak of unhealthy runs, open incidents, action."""
    both = previous.alias("p").join(events.alias("e"), "source", "full_outer")
    fresh = F.col("e.status").isNotNull()
    status = F.coalesce("e.status", "p.last_status")
    streak = F.when(~F.col("e.status").isin(UNHEALTHY), 0).when(F.col("p.last_status").isin(UNHEALTHY), F.coalesce("p.consecutive_unhealthy", F.lit(0)) + 1).otherwise(1)
    rows = both.select(
        "source",
        status.alias("last_status"),
        F.when(fresh, present("p.last_status")).otherwise(present("p.previous_status")).alias("previous_status"),
        F.when(fresh, streak).otherwise(F.coalesce("p.consecutive_unhealthy", F.lit(0))).cast("long").alias("consecutive_unhealthy"),
    )
    opened = queue.where(F.col("status").isin(OPEN)).groupBy("source").agg(F.count("*").alias("open_incidents"), F.collect_set("status").alias("_states"))
    rows = rows.join(opened, "source", "left").withColumn("_states", F.coalesce("_states", F.array().cast("array<string>")))
    return rows.select("source", "last_status", "previous_status", "consecutive_unhealthy", F.coalesce("open_incidents", F.lit(0).cast("long")).alias("open_incidents"), next_action(F.col("last_status"), F.col("_states")).alias("next_action"))


def actionable_first(state: DataFrame) -> DataFrame:
    return state.orderBy(F.col("next_action") == "none", F.lower("source"))


def status_changes(queue: DataFrame, notified: DataFrame) -> DataFrame:
    """Incidents worth a message whose status is not the last one sent."""
    sent = notified.select("id", F.col("status").alias("_sent"))
    rows = queue.where("id <> ''").where(F.col("status").isin(NOTIFIABLE)).join(sent, "id", "left")
    return rows.where(~F.col("status").eqNullSafe(F.col("_sent"))).drop("_sent").orderBy("date", "source")


def mark_sent(notified: DataFrame, sent: DataFrame, now: Column) -> DataFrame:
    """The notification state after a delivery."""
    fresh = sent.select("id", "status", now.alias("notified_at"))
    return notified.join(fresh.select("id"), "id", "left_anti").unionByName(fresh)


def report(state: DataFrame, queue: DataFrame) -> DataFrame:
    """One row of totals over channels and incidents."""
    count = lambda holds, name: F.sum(F.when(holds, 1).otherwise(0)).cast("long").alias(name)
    s = state.agg(F.count("*").alias("channels"), count(F.col("last_status").isin(SUCCESS), "healthy"), count(F.col("last_status").isin(UNHEALTHY), "unhealthy"))
    q = queue.agg(count(F.col("status").isin(OPEN), "open_incidents"), count(F.col("status") == "pending_confirmation", "pending"), count(F.col("status") == "recovery_failed", "failed"), count(F.col("status") == "recovered", "recovered"))
    return s.crossJoin(q)  # one row each
