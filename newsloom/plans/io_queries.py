"""Queries that write and read again, registered beside those of ``registry``: what is stored comes back as it was."""

from __future__ import annotations

import datetime as dt
import io

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.plans import inputs, sql
from newsloom.plans.registry import dated, query
from newsloom.sources import feeds, files, listings, scratch, workbooks
from newsloom.streaming.ingest import event_counts


@query(sql.ARTICLES + "SELECT url, title, md5(content) AS digest, content_status, '' AS crawled_at, cls AS industry_classification_status FROM articles")
def json_articles(spark, d):
    """SNK-1, SRC-1, SRC-6, PRJ-1: normalised articles as JSON lines, among lines that are none, read again."""
    path = scratch.fresh(spark, "json")
    rows = inputs.articles(spark, d).drop("seq")
    files.write_articles(rows, path)
    rows.select(F.concat(F.lit('{"url": '), "url").alias("value")).write.mode("append").text(path)
    return files.read_articles(spark, path).select("url", "title", F.md5("content").alias("digest"), "content_status", "crawled_at", "industry_classification_status")


COLUMNS = ["title", "published_at", "content", "url", "source_name", "domain", "sub_domain"]


@query(sql.ARTICLES + "SELECT date AS summary_date, url, title, md5(content) AS digest, sub_domain FROM articles WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'")
def csv_window(spark, d):
    """SNK-3, SRC-7, SRC-8, SRC-9, SET-1: three days exported as CSV, read as a window of five of which two are not there."""
    folder, rows = scratch.fresh(spark, "csv"), dated(spark, d)
    for day in (dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7)):
        files.export_day(rows, folder, day, COLUMNS, F.col("date"))
    read = files.read_window(spark, folder, dt.date(2024, 1, 4), dt.date(2024, 1, 8), COLUMNS)
    return read.select("summary_date", "url", "title", F.md5("content").alias("digest"), "sub_domain")


@query(sql.ARTICLES + "SELECT date, seq, CASE WHEN date = DATE '2024-01-09' THEN 'second' ELSE 'first' END AS written FROM articles WHERE date IS NOT NULL")
def partitioned_days(spark, d):
    """SNK-4: articles in a folder a day, of which one day is written again and the others are left alone."""
    path, rows = scratch.fresh(spark, "days"), dated(spark, d).where("date IS NOT NULL").select("date", "seq")
    files.write_partitioned(rows.withColumn("written", F.lit("first")), path, "date")
    files.write_partitioned(rows.where("date = '2024-01-09'").withColumn("written", F.lit("second")), path, "date")
    return spark.read.parquet(path).select("date", "seq", "written")


@query(sql.DAYS + "SELECT date, source, article_count + 1 AS article_count FROM days")
def state_versions(spark, d):
    """SNK-6: the last of two versions, of which the second is made of the first."""
    folder, days = scratch.fresh(spark, "state"), inputs.channel_days(spark, d).select("date", "source", "article_count")
    first = spark.read.parquet(files.write_version(days, folder, "a"))
    files.write_version(first.withColumn("article_count", F.col("article_count") + 1), folder, "b")
    return spark.read.parquet(files.latest_version(spark, folder))


def feed_bodies(spark, d, per_feed=20):
    """Feeds of twenty documents each: well-formed, with an entity that nobody has declared, with tags left open, cut off."""
    k, number = F.col("doc_id"), F.floor(F.col("doc_id") / per_feed).cast("int")
    kind = number % 4
    title = F.concat(F.lit("Q &amp; A "), k.cast("string"), F.when(kind == 1, "&middot;").otherwise(""))
    close = lambda tag: F.when(kind == 2, "").otherwise(f"</{tag}>")
    body = F.when(k % 2 == 0, F.concat(F.lit("<description>&lt;p&gt;text&lt;/p&gt; "), k.cast("string"), close("description"))).otherwise(F.concat(F.lit("<description>x"), close("description"), F.lit("<content:encoded><![CDATA[<p>whole <b>text</b></p> "), k.cast("string"), F.lit("]]>"), close("content:encoded")))
    item = F.concat(F.lit("<item><title>"), title, close("title"), F.lit("<link>https://x.example/"), k.cast("string"), close("link"), F.lit("<pubDate>Fri, 05 Jan 2024</pubDate>"), body, F.lit("</item>"))
    docs = inputs.table(spark, d, "documents").select("doc_id", "source")
    items = docs.groupBy("source", number.alias("number")).agg(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("item")))).alias("items"))  # per_feed at most
    text = F.concat(F.lit('<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>'), F.array_join(F.transform("items", lambda x: x["item"]), ""), F.when(F.col("number") % 4 == 3, "<item><title>cut").otherwise("</channel></rss>"))
    return items.select("source", "number", text.alias("body"))


@query(r"""SELECT source, CAST(doc_id // 20 AS INT) AS number, 'Q & A ' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id // 20 % 4 = 1 THEN '·' ELSE '' END AS title, 'https://x.example/' || CAST(doc_id AS VARCHAR) AS url, 'Fri, 05 Jan 2024' AS published_at,
  CASE WHEN doc_id % 2 = 0 THEN 'text ' ELSE 'whole text ' END || CAST(doc_id AS VARCHAR) AS summary, doc_id % 2 = 1 AS content_is_full FROM documents""")
def feed_entries(spark, d):
    """SRC-12, SRC-14: entries of feeds, three quarters of which are not well-formed."""
    found = feeds.entries(feed_bodies(spark, d))
    return found.select("source", "number", "title", "url", "published_at", F.regexp_replace("summary", r"\s+", " ").alias("summary"), "content_is_full")


@query("SELECT source, CAST(min(doc_id // 20) AS INT) AS number, count(*) FILTER (doc_id // 20 = m) AS entries FROM (SELECT *, min(doc_id // 20) OVER (PARTITION BY source) AS m FROM documents) GROUP BY source")
def discovered_feeds(spark, d):
    """SRC-13: of the candidates of a channel (pages that are no feed stand between) the first that has entries."""
    bodies = feed_bodies(spark, d)
    tried = bodies.select(F.col("source").alias("name"), (F.col("number") * 2 + 1).alias("rank"), F.col("number").cast("string").alias("url"), "body")
    none = bodies.select(F.col("source").alias("name"), (F.col("number") * 2).alias("rank"), F.lit("none").alias("url"), F.when(F.col("number") % 2 == 0, "<html><body>no feed</body></html>").alias("body"))
    return feeds.first_feeds(tried.unionByName(none)).groupBy(F.col("name").alias("source"), F.col("feed_url").cast("int").alias("number")).agg(F.count("*").alias("entries"))


@query("SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal * 100 AS BIGINT) AS cents FROM customer WHERE c_custkey IS NOT NULL")
def sheet_rows(spark, d):
    """SRC-19, SNK-13: customers in workbooks of a thousand rows each, written and read row by row."""
    c = inputs.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))

    def book(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        made = workbooks.Book(out)
        made.sheet("S", ["no", "Key ", "name", "nation", "balance"], (["", r.c_custkey, r.c_name, r.c_nationkey, r.c_acctbal] for r in rows.itertuples()), link="")
        made.close()
        return pd.DataFrame({"path": ["x"], "content": [out.getvalue()]})

    books = c.groupBy(F.floor(F.col("c_custkey") / 1000)).applyInPandas(book, "path string, content binary")  # a thousand rows at most
    rows = workbooks.rows_of(books)
    cell = lambda name: workbooks.column([name])
    return rows.select(cell("Key").cast("long").alias("c_custkey"), cell("name").alias("c_name"), cell("nation").cast("int").alias("c_nationkey"), F.round(cell("balance").cast("double") * 100).cast("long").alias("cents"))


@query(r"""WITH RECURSIVE f AS (
  SELECT source AS name, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank, doc_id // 20 % 7 IN (1, 2) AS failed, DATE '2024-01-01' + CAST((doc_id * 7 + doc_id // 30) % 30 AS INT) AS date FROM documents
), walk AS (
  SELECT name, CAST(0 AS BIGINT) AS rank, 0 AS older, 0 AS failures, 0 AS taken, false AS takes FROM f GROUP BY name
  UNION ALL
  SELECT w.name, f.rank, CASE WHEN f.failed THEN w.older WHEN f.date < DATE '2024-01-10' THEN w.older + 1 ELSE 0 END, CASE WHEN f.failed THEN w.failures + 1 ELSE 0 END,
    w.taken + CASE WHEN NOT f.failed AND f.date = DATE '2024-01-10' THEN 1 ELSE 0 END, NOT f.failed AND f.date = DATE '2024-01-10'
  FROM walk w JOIN f ON f.name = w.name AND f.rank = w.rank + 1 WHERE w.older < 6 AND w.failures < 6 AND w.taken < 3
)
SELECT name, rank FROM walk WHERE takes""")
def links_in_a_row(spark, d):
    """LIM-3, LIM-1: articles of a day among a channel's links, until six older ones (or failures) in a row or three of the day."""
    k = F.col("doc_id")
    docs = inputs.table(spark, d, "documents").select(F.col("source").alias("name"), "doc_id", k.isNotNull().alias("there"))
    ranked = docs.withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy("doc_id")).cast("long"))
    fetched = ranked.select("name", "rank", (F.floor(k / 20) % 7).isin(1, 2).alias("failed"), F.date_add(F.lit("2024-01-01").cast("date"), ((k * 7 + F.floor(k / 30)) % 30).cast("int")).alias("date"))
    return listings.until_in_a_row(fetched, F.lit("2024-01-10").cast("date"), 3, in_a_row=6).select("name", "rank")


@query("SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark, d):
    """Windows over events, as the stream counts them."""
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return event_counts(e).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(sql.ARTICLES + "SELECT seq, CASE WHEN title = '' THEN '' ELSE title END AS title, source_name, domain FROM articles")
def normalised_articles(spark, d):
    """PRJ-1: the columns of an article, in order, nulls as empty texts."""
    rows = inputs.articles(spark, d).withColumn("title", F.nullif("title", F.lit("")))
    kept = A.normalise(rows.withColumn("industry_leaf", F.col("seq").cast("string")))
    return kept.select(F.col("industry_leaf").cast("long").alias("seq"), "title", "source_name", "domain")
