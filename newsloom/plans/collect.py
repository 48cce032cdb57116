"""The daily collection: channels, their feeds and listings, candidates, pages, articles of the day, health.

All channels go through every step together. What has been asked of the network is stored before it is used, so no
step asks again; what a run has stored is below a folder of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions.channels import expects_on, skip_reason
from newsloom.functions.dates import article_date, published_date, url_date
from newsloom.functions.free_dates import free_date
from newsloom.functions.html import page_articles
from newsloom.functions.text import present
from newsloom.functions.urls import address_key, feed_url
from newsloom.operators import articles as A
from newsloom.operators import audit, reports
from newsloom.operators.incidents import padded
from newsloom.sources import feeds, fetching, files, listings
from newsloom.sources.store import Store

#: Articles of a channel and candidates looked at in a run.
LIMIT, CANDIDATES = 20, 100
HEALTH = "source string, frequency string, status string, reason string, crawl_mode string, error_type string, " + ", ".join(f"{c} long" for c in files.HEALTH_COUNTS)
#: Feeds that channels have beside what their notes name are in the rules of ``sources.channels``.
STORED = {c: "string" for c in A.FIELDS if c != "industry_classifications"}


class Collection:
    """One run's steps over all channels; every table that the network has filled is stored under ``folder``."""

    def __init__(self, spark: SparkSession, home: str, day: str, now: str, get: fetching.Get, **pace) -> None:
        self.spark, self.day, self.now, self.get, self.pace = spark, F.lit(day).cast("date"), now, get, pace
        self.folder = f"{home}/runs/{day}-{re.sub(r'[^0-9]', '', now)}"

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        return self.spark.read.schema(rows.schema).parquet(files.write_version(rows, f"{self.folder}/{name}", "run"))

    def fetched(self, name: str, asked: DataFrame, url: str) -> DataFrame:
        """Rows with the page of their address: ``html, error``; each address is asked once."""
        pages = self.put(name, fetching.fetch(asked.select(F.col(url).alias("url")), self.get, **self.pace))
        return asked.join(pages.select(F.col("url").alias(url), "html", "error"), url, "left")

    def entries(self, active: DataFrame, most: int) -> DataFrame:
        """Entries of the channels' feeds that they take: ``name, rank, url, title, published_at, summary, ...``."""
        found = feeds.fetch_entries(active.select("name", "feed_url"), self.get, limit=most, **self.pace)
        return self.put("entries", listings.accepted_entries(found.withColumn("rank", F.col("pos") + 1), self.spark))

    def listed(self, rest: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
        """Links and dated cards of listings: ``name, rank, url, day, slack``; and errors of listing pages: ``name, error``."""
        errors: list[DataFrame] = []

        def read(todo: DataFrame) -> DataFrame:
            pages = self.fetched(f"listing{len(errors)}", todo, "page_url")
            errors.append(pages.where("error IS NOT NULL").select("name", "error"))
            return pages.select("name", "page_url", "page_no", "html")

        folder = listings.crawl(self.spark, rest.select("name", "url"), read, self.folder, day=self.day, limit=most)
        found = self.spark.read.schema(listings.FOUND).parquet(*files.committed(self.spark, folder))
        links = listings.article_links(found.where(F.col("selector") >= 0), self.spark, most).select("name", "rank", F.col("link").alias("url"), F.lit(None).cast("date").alias("day"), F.lit(0).alias("slack"))
        order = Window.partitionBy("name").orderBy("page_no", "pos")
        cards = listings.dated_cards(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("name", "rank", F.col("link").alias("url"), F.col("published_date").alias("day"), F.lit(1).alias("slack"))
        failed = errors[0]
        for more in errors[1:]:  # one a round
            failed = failed.unionByName(more)
        return links.unionByName(cards), failed

    def run(self, sources: DataFrame, store: Store, *, limit: int = LIMIT, candidate_limit: int = CANDIDATES) -> DataFrame:
        """Puts the day's articles into the store and gives the health of every channel."""
        sources = self.put("sources", sources.withColumn("skip", skip_reason(F.col("note"), F.col("url"))).withColumn("feed_url", feed_url(F.col("note"))))
        active, most = sources.where("skip IS NULL"), max(limit, candidate_limit)
        entries = self.entries(active, most)
        of_feed = entries.select("name", "rank", "url", F.coalesce(published_date(F.col("published_at")), free_date(F.col("published_at"))).alias("day"), F.lit(0).alias("slack"))
        links, errors = self.listed(active.join(entries.select("name").distinct(), "name", "left_anti"), most)
        seen = self.put("candidates", of_feed.unionByName(links).dropDuplicates(["name", "url"]).withColumn("key", address_key(F.col("url"))))
        before = store.snapshot().number
        stored = store.read(before)
        day = F.coalesce("day", url_date(F.col("url")))
        todo = seen.where(day.isNull() | day.between(F.date_sub(self.day, F.col("slack")), self.day))  # a card may be a day behind
        if stored is not None:
            todo = todo.join(files.collected(stored, F.col("_key")).withColumnRenamed("url_key", "key"), "key", "left_anti")
        articles = self.put("articles", self.read_articles(todo, entries, active))
        done = articles.withColumn("date", article_date(F.col("published_at"), F.col("url")))
        kept = listings.until_in_a_row(done.withColumn("failed", (F.col("title") == "") & (F.col("content") == "")), self.day, limit)
        batch = padded(kept.withColumn("published_at", F.col("date").cast("string")).withColumn("crawled_at", F.lit(self.now)), ", ".join(f"{c} {k}" for c, k in STORED.items())).fillna("")
        numbered = batch.withColumn("_seq", F.monotonically_increasing_id()).withColumn("_key", address_key(F.col("url")))
        store.put(self.put("batch", numbered))
        return self.health(sources, seen, articles, errors, entries, stored, store)

    def read_articles(self, todo: DataFrame, entries: DataFrame, active: DataFrame) -> DataFrame:
        """Candidates with their pages as articles, filled up from their feed entries; nothing but an entry may be there."""
        asked = self.put("asked", todo.select("name", "rank", "url"))
        pages = self.fetched("pages", asked, "url").where("html IS NOT NULL").select("url", "html", F.col("name").alias("source_name"))
        read = page_articles(pages).withColumnsRenamed({"url": "target", "source_name": "name", "requested_url": "url"})
        every = asked.join(read, ["name", "url"], "left")
        filled = every.select("name", "rank", "url", F.coalesce("target", "url").alias("target"), *(present(c).alias(c) for c in ("title", "published_at", "content", "content_extraction")), F.coalesce("content_status", F.lit("missing")).alias("content_status"))
        merged = feeds.merge_pages(filled.withColumn("_at", F.concat_ws("\n", "name", "url")), entries.withColumn("_at", F.concat_ws("\n", "name", "url")), "_at")
        rows = filled.select("name", "rank", "target", F.concat_ws("\n", "name", "url").alias("_at")).join(merged, "_at").drop("_at").withColumnRenamed("target", "url")
        return rows.join(active.select("name", F.col("name").alias("source_name"), "domain", "sub_domain"), "name")

    def health(self, sources: DataFrame, seen: DataFrame, articles: DataFrame, errors: DataFrame, entries: DataFrame, stored: DataFrame | None, store: Store) -> DataFrame:
        """Health rows (``HEALTH``) of all channels: skipped ones with the reason, failed ones with their first error."""
        now = store.read()
        fresh = now.where(F.col("crawled_at") == self.now).select("_key", "source_name", "content", "content_status") if now is not None else self.spark.createDataFrame([], "_key string, source_name string, content string, content_status string")
        known = fresh.limit(0).select("_key") if stored is None else stored.select("_key")
        fresh = fresh.join(known.distinct().withColumn("_old", F.lit(True)), "_key", "left").withColumn("_old", F.coalesce("_old", F.lit(False)))
        stats = reports.content_stats(fresh).join(fresh.groupBy("source_name").agg(F.sum((~F.col("_old")).cast("long")).alias("new_articles"), F.sum(F.col("_old").cast("long")).alias("refreshed_articles")), "source_name").withColumnRenamed("source_name", "name")
        counts = seen.groupBy("name").agg(F.count("*").alias("candidates_seen")).join(articles.groupBy("name").agg(F.count("*").alias("pages_fetched")), "name", "left")
        modes = entries.select("name", F.lit("rss").alias("crawl_mode")).distinct()
        failures = errors.groupBy("name").agg(F.min("error").alias("error"))
        rows = sources.join(counts, "name", "left").join(stats, "name", "left").join(modes, "name", "left").join(failures, "name", "left")
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        changed = zero("new_articles") + zero("refreshed_articles")
        failed = (zero("candidates_seen") == 0) & F.col("error").isNotNull()
        crawled = audit.crawl_status(changed, zero("usable_articles"), expects_on(F.col("frequency"), self.day))
        rows = rows.withColumn("status", F.when(F.col("skip").isNotNull(), "skipped").when(failed, "failed").otherwise(crawled))
        rows = rows.withColumn("reason", F.coalesce("skip", F.when(failed, F.col("error")), F.lit(""))).withColumn("error_type", F.when(failed, "FetchError").otherwise(""))
        rows = rows.withColumn("source", F.col("name")).withColumn("crawl_mode", F.when(F.col("skip").isNull(), F.coalesce("crawl_mode", F.lit("listing"))).otherwise(""))
        return self.put("health", padded(rows, HEALTH).fillna(0, files.HEALTH_COUNTS))


def collect(spark: SparkSession, home: str, sources: DataFrame, store: Store, get: fetching.Get, day: str, now: str, *, only: tuple[str, ...] = (), limit: int = LIMIT, candidate_limit: int = CANDIDATES, **pace) -> DataFrame:
    """One day's collection of ``sources`` (``name, url, note, frequency, domain, sub_domain``) into a store; its health.

    ``get`` is the request, ``pace`` what ``fetching.fetch`` takes. Channels that are asked for by name and are not there
    are an error before anything is fetched. Failures of channels are appended to the ledger of errors.
    """
    chosen = reports.only_sources(sources, only) if only else sources
    step = Collection(spark, home, day, now, get, **pace)
    health = step.run(chosen, store, limit=limit, candidate_limit=candidate_limit)
    broken = health.where("status = 'failed'").join(chosen.select(F.col("name").alias("source"), "url"), "source")
    failures = reports.error_records(broken.withColumn("error", F.col("reason")), F.lit(day), F.lit(now))
    failures.write.mode("append").json(f"{home}/source-errors")
    return health
