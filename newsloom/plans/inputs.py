"""Logical inputs of the engine, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles over ``documents``: addresses with tracking and dates, publication times in several spellings, some
    statuses blank, two records for every seventh address."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    i = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int"))
    number = F.when(i % 7 == 0, F.floor(i / 14) * 14).otherwise(i).cast("string")
    path = F.when(i % 3 == 0, F.date_format(day, "yyyy/MM/dd")).otherwise("news")
    return d.select(
        i.alias("seq"),
        F.substring(F.substring_index("text", "\n", 1), 1, 60).alias("title"),
        F.when(i % 4 == 1, "").when(i % 4 == 2, F.concat(day.cast("string"), F.lit("T23:30:00+00:00"))).otherwise(day.cast("string")).alias("published_at"),
        F.col("text").alias("content"),
        F.element_at(F.array(*map(F.lit, ["full", "", "incomplete", "missing", "unknown"])), (i % 5 + 1).cast("int")).alias("content_status"),
        F.element_at(F.array(*map(F.lit, ["", "dom", "rss_excerpt", "public_preview", "dom", "dom"])), (i % 6 + 1).cast("int")).alias("content_extraction"),
        F.concat(F.lit("http://www.Example.com/"), "source", F.lit("/"), path, F.lit("/"), number, F.lit(".html?utm_source=feed&b=2&a=1#top")).alias("url"),
        F.col("source").alias("source_name"),
        F.col("lang").alias("domain"),
        F.when(i % 2 == 0, "even").otherwise("").alias("sub_domain"),
        F.element_at(F.array(*map(F.lit, ["classified", "", "error", "unclassified"])), (i % 4 + 1).cast("int")).alias("industry_classification_status"),
        F.concat(F.lit("v"), (i % 3).cast("string")).alias("industry_taxonomy_version"),
    )


def channel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics over ``events``: a channel for every type and fifth of users, without some days, with zeros."""
    e = table(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp_ntz")).alias("date"), F.concat_ws("-", "event_type", (F.col("user_id") % 5).cast("string")).alias("source"), "value", "event_id")
    n = e.groupBy("date", "source").agg(F.count("*").alias("n"), F.sum(F.when(F.col("event_id") % 4 != 0, 1).otherwise(0)).alias("u"), F.countDistinct(F.col("event_id") % 97).alias("d"))
    k = F.dayofmonth("date") * 7 + F.length("source") * 3 + F.col("n")
    count = F.when(k % 5 == 0, 0).otherwise(F.col("n")).cast("long")
    rows = n.where(k % 11 != 0).select(
        "date", "source", count.alias("article_count"), F.least("u", count).cast("long").alias("usable_articles"), F.greatest(count - F.col("d"), F.lit(0)).cast("long").alias("duplicate_articles"),
        F.when(F.col("source").endswith("-0"), "工作日").when(F.col("source").endswith("-1"), "每周").otherwise("每日").alias("frequency"),
        F.when(k % 13 == 0, "failed").when(k % 17 == 0, "skipped").when(count == 0, "zero").when(k % 19 == 0, "historical").otherwise("healthy").alias("crawl_status"),
    )
    from newsloom.functions.channels import expects_on

    return rows.withColumn("expected_daily", expects_on(F.col("frequency"), F.col("date")))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recovery queue in all states: an incident for every channel day that was neither healthy nor zero."""
    states = ["pending_confirmation", "confirmed", "recovering", "recovered", "recovery_failed", "ignored"]
    d = channel_days(spark, sf_dir).where(~F.col("crawl_status").isin("healthy", "zero"))
    k = F.dayofmonth("date") + F.length("source") + F.col("article_count")
    return d.select(
        F.concat(F.col("date").cast("string"), F.lit("::"), "source").alias("id"), "date", "source", F.element_at(F.array(*map(F.lit, states)), (k % 6 + 1).cast("int")).alias("status"), (k % 3).alias("attempts"),
        F.lit(0).cast("long").alias("recovered_articles"), F.when(k % 2 == 0, "missing_run_record").otherwise("timeout").alias("diagnosis_code"), F.lit("2024-02-01").alias("updated_at"),
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health rows of one run: a row per channel with a reason from its last day."""
    d = channel_days(spark, sf_dir)
    last = d.groupBy("source").agg(F.max_by(F.struct("date", "frequency", "crawl_status", "article_count"), F.col("date")).alias("l")).select("source", "l.*")
    reasons = ["", "HTTP 403 Forbidden", "Read timed out", "HTTP 503 bad gateway", "selector not found; api_key=abc123, x", "missing run record"]
    k = F.col("article_count") + F.length("source")
    return last.select(
        "source", "date", "frequency", F.col("crawl_status").alias("status"), F.element_at(F.array(*map(F.lit, reasons)), (k % 6 + 1).cast("int")).alias("reason"), (k % 3).alias("candidates_seen"), (k % 2).alias("pages_fetched"), F.col("article_count").alias("new_articles"),
    )
