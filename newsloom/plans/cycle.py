"""The daily cycle over stored tables: audit, gaps, queue, ledger, channel state, backfill and messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.channels import OPEN, expects_on
from newsloom.functions.dates import article_date
from newsloom.functions.urls import address_key
from newsloom.operators import audit, incidents, ledger
from newsloom.operators.incidents import INCIDENT, padded
from newsloom.sources.edges import deliver
from newsloom.sources.files import committed, latest_version, write_version

QUEUE = INCIDENT
STATE = ledger.CHANNEL + ", open_incidents long, next_action string"
STATS = "date date, source string, frequency string, crawl_status string, article_count long, usable_articles long"
LEDGER = ledger.EVENT
SEEN = "id string, seq long"
SENT = "id string, status string, notified_at string"

#: Reads the article table anew, so that files which a backfill has added are seen.
Reader = Callable[[], DataFrame]


def current(spark: SparkSession, home: str, name: str, schema: str) -> DataFrame:
    """The last committed version of a state table, empty if there is none."""
    last = latest_version(spark, f"{home}/{name}")
    return spark.read.schema(schema).parquet(last) if last else spark.createDataFrame([], schema)


def events(spark: SparkSession, home: str) -> DataFrame:
    """The whole ledger: every committed version adds events to it."""
    paths = committed(spark, f"{home}/ledger")
    return spark.read.schema(LEDGER).parquet(*paths) if paths else spark.createDataFrame([], LEDGER)


def inventory(articles: DataFrame) -> DataFrame:
    """Counts per channel and day of an article table."""
    dated = articles.withColumn("date", article_date(F.col("published_at"), F.col("url"))).withColumn("url_key", address_key(F.col("url")))
    return audit.inventory(dated, "date", "url_key")


class Cycle:
    """One day's cycle in steps; every step reads stored versions and adds new ones, whose paths are in ``out``."""

    def __init__(self, spark: SparkSession, home: str, day: str, now: str) -> None:
        self.spark, self.home, self.day, self.now, self.out = spark, home, day, now, {}

    @property
    def target(self) -> Column:
        return F.lit(self.day).cast("date")

    def table(self, name: str, schema: str) -> DataFrame:
        return current(self.spark, self.home, name, schema)

    def put(self, name: str, rows: DataFrame, schema: str | None = None) -> DataFrame:
        """Stores a new version and reads it back, so later steps start from files."""
        self.out[name] = write_version(padded(rows, schema) if schema else rows, f"{self.home}/{name}", self.day)
        return self.spark.read.parquet(self.out[name])

    def count(self, found: DataFrame, health: DataFrame | None) -> DataFrame:
        """Statistics brought up to date with the inventory, and with the run's health rows if there are any."""
        stats = audit.merge_stats(self.table("stats", STATS), found)
        if health is not None:
            stats = audit.merge_health(stats, health, found, self.target)
        return self.put("stats", stats, STATS)

    def judge(self, stats: DataFrame, found: DataFrame) -> DataFrame:
        rich = stats.withColumn("expected_daily", expects_on(F.col("frequency"), F.col("date")))
        rich = rich.join(found.select("date", "source", "duplicate_articles"), ["date", "source"], "left").fillna(0, ["duplicate_articles"])
        return self.put("audit", audit.channel_anomalies(audit.zero_streak(audit.with_baseline(rich, "article_count", "source"))))

    def gaps(self, judged: DataFrame, found: DataFrame) -> DataFrame:
        """Days without a run, as cells that a diagnosis of their own goes with."""
        days = audit.missing_runs(judged, audit.daily_summary(judged), found, latest=self.target)
        return days.withColumn("crawl_status", F.lit("failed")).withColumn("article_count", F.lit(0).cast("long")).withColumn("expected_daily", F.lit(True)).withColumn("anomaly_level", F.lit("critical")).withColumn("anomaly_codes", F.lit("missing_run_record"))

    def sync(self, judged: DataFrame, gaps: DataFrame, health: DataFrame) -> DataFrame:
        """The queue after today's cells, gaps, and days that have articles now, however late."""
        stored = self.table("queue", QUEUE)
        open_ = stored.where(F.col("status").isin(OPEN)).select("date", "source", F.lit(True).alias("_open"))
        late = (F.col("crawl_status") == "recovered") | (F.coalesce("_open", F.lit(False)) & (F.col("article_count") > 0))
        cells = judged.join(open_, ["date", "source"], "left").where((F.col("date") == self.target) | late)
        cells = padded(cells, incidents.CELL).unionByName(padded(gaps, incidents.CELL))
        told = padded(health.withColumn("date", self.target), incidents.REASON)
        own = padded(gaps.withColumn("reason", F.lit(ledger.MISSING_REASON)).withColumn("error_type", F.lit(ledger.MISSING_ERROR)).withColumn("crawl_mode", F.lit("scheduled")), incidents.REASON)
        queue = incidents.sync_days(cells, stored, told.unionByName(own.fillna(0, ["candidates_seen", "pages_fetched"])), F.lit(self.now))
        return self.put("queue", incidents.auto_confirm(queue, F.lit(self.now)))

    def record(self, gaps: DataFrame, health: DataFrame, queue: DataFrame) -> None:
        """Appends events that are new to the ledger and takes the fold of the channels on by them.

        The state takes in whatever the ledger holds behind its own last number, so a run that died between the two
        is made up for.
        """
        now, seen = F.lit(self.now), self.table("seen", SEEN)
        told = ledger.attempt_events(health.withColumn("date", self.target), queue, now)
        last = events(self.spark, self.home).agg(F.max("seq")).first()[0] or 0
        fresh = ledger.append(ledger.missing_events(gaps, now).unionByName(told), seen, last)
        if not fresh.isEmpty():
            fresh = self.put("ledger", fresh, LEDGER)
            self.put("seen", ledger.remember(seen, fresh), SEEN)
        self.fold(queue)

    def fold(self, queue: DataFrame) -> DataFrame:
        before = self.table("state", STATE)
        at = before.agg(F.max("seq")).first()[0] or 0
        state = ledger.advance(before, events(self.spark, self.home).where(F.col("seq") > at))
        return self.put("state", ledger.with_incidents(state, queue), STATE)

    def backfill(self, run: Callable[[DataFrame], DataFrame | None], read: Reader) -> None:
        """Confirmed incidents in two steps: stored as under way, fetched, then counted in the table as it is now."""
        queue = self.table("queue", QUEUE)
        if queue.where(F.col("status").isin("confirmed", "recovering")).isEmpty():
            return
        queue = self.put("queue", incidents.begin_recovery(queue, F.lit(self.now)))
        outcomes = run(queue.where("status = 'recovering'"))
        found = inventory(read())
        self.count(found, None)
        queue = self.put("queue", incidents.end_recovery(queue, found, F.lit(self.now), outcomes))
        self.fold(queue)

    def notify(self, send: Callable[[str], bool], render: Callable[[list[dict], int], str] | None = None) -> bool:
        sent = self.table("sent", SENT)
        changes = incidents.status_changes(self.table("queue", QUEUE), sent)
        done = deliver(changes, send, render=render)
        if done:
            self.put("sent", incidents.mark_sent(sent, changes, F.lit(self.now)), SENT)
        return done


def run(spark: SparkSession, home: str, articles: DataFrame | Reader, health: DataFrame, day: str, now: str, *, backfill: Callable[[DataFrame], DataFrame | None] | None = None, send: Callable[[str], bool] | None = None) -> dict[str, str]:
    """One day's cycle; returns the paths of the new versions. Run again for the day it writes the same tables.

    Every run adds versions and leaves those that it reads alone, so a run that fails half way loses nothing. Attempts
    are known by their id: a day that is run again adds none to the ledger and none to a channel's streak, and what a
    person has resolved in between stays resolved, whatever ``now`` the run is given.

    ``articles`` reads the article table (a function, so that what a backfill adds is seen; a frame is taken as it is),
    ``health`` are the run's health rows. ``backfill`` is called with the incidents that are under way before articles
    are counted again, and may return ``id, exit_code, reason`` of attempts; ``send`` delivers messages.
    """
    read = articles if callable(articles) else lambda: articles
    cycle = Cycle(spark, home, day, now)
    found = inventory(read())
    judged = cycle.judge(cycle.count(found, health), found)
    gaps = cycle.gaps(judged, found)
    cycle.record(gaps, health, cycle.sync(judged, gaps, health))
    if backfill:
        cycle.backfill(backfill, read)
    if send:
        cycle.notify(send)
    return cycle.out
