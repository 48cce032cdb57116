"""Weekly and monthly roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_window(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows whose ``summary_date`` lies in a window, both ends included; the comparison reaches the scan."""
    return rows.where(F.col("summary_date").between(first, last))


def detail(rows: DataFrame) -> DataFrame:
    """Rows for an export: the day of the roll-up as the publication date."""
    return rows.withColumn("published_at", F.col("summary_date").cast("string"))


def by_source(rows: DataFrame) -> DataFrame:
    keys = ["source_name", "domain", "sub_domain", "category"]
    out = rows.groupBy(*keys).agg(F.count("*").alias("article_count"), F.min("summary_date").alias("first_date"), F.max("summary_date").alias("last_date"))
    return out.orderBy(F.desc("article_count"), *keys)


def by_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by keys (domain and sub-domain, or category and its method), most first."""
    return rows.groupBy(*keys).agg(F.count("*").alias("article_count")).orderBy(F.desc("article_count"), *keys)


def by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("summary_date").agg(F.count("*").alias("article_count")).orderBy("summary_date")
