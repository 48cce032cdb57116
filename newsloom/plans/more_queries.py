"""Queries of runs, reports, text bodies and feeds, registered beside those of ``registry``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import articles as A
from newsloom.operators import reports
from newsloom.plans import inputs, sql
from newsloom.plans.registry import dated, judged, query
from newsloom.sources import feeds, files

#: Statements that several of the queries share.
STORED = sql.ARTICLES + r""", marked AS (
  SELECT *, content || CASE WHEN seq % 11 = 0 THEN ' Verify you are human, Cloudflare' ELSE '' END AS body FROM articles
)
"""


def marked(spark, d):
    """Articles, some of which are stored challenge pages."""
    a = inputs.articles(spark, d)
    return a.withColumn("content", F.concat("content", F.when(F.col("seq") % 11 == 0, " Verify you are human, Cloudflare").otherwise("")))


@query(sql.ARTICLES + r"""SELECT source_name, count(*) AS articles, count(*) FILTER (content_status = 'full') AS usable_articles, count(*) FILTER (content_status <> 'full') AS incomplete_articles,
  count(*) FILTER (c < 500) AS short_articles, min(c) AS content_chars_min, CAST(floor(quantile_cont(c, 0.5)) AS BIGINT) AS content_chars_median, max(c) AS content_chars_max
FROM (SELECT *, length(trim(content, ' ' || chr(9) || chr(10) || chr(13))) AS c FROM articles) GROUP BY source_name""")
def content_stats(spark, d):
    """AGG-4."""
    return reports.content_stats(inputs.articles(spark, d))


@query(sql.DAYS + "SELECT source, date, max(article_count) AS article_count FROM (SELECT source, date, article_count FROM days UNION ALL SELECT source, date, usable_articles + 3 FROM days) GROUP BY source, date")
def most_articles(spark, d):
    """AGG-11."""
    days = inputs.channel_days(spark, d)
    return reports.most_articles(days.select("source", "date", "article_count").unionByName(days.select("source", "date", (F.col("usable_articles") + 3).alias("article_count"))))


@query(sql.DAYS + sql.SUMMARY + "SELECT date FROM summary WHERE sources_configured > 0 AND date <= (SELECT max(date) FROM summary WHERE sources_configured > 0)")
def audited_days(spark, d):
    """AGG-14: the latest day is audited, so all days up to it count."""
    from newsloom.operators import audit

    summary = audit.daily_summary(inputs.channel_days(spark, d))
    latest = summary.agg(F.max("date")).first()[0]
    return reports.audited_days(summary, F.lit(latest).cast("date"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_name IN (SELECT min(s_name) FROM supplier UNION SELECT max(s_name) FROM supplier)")
def only_sources(spark, d):
    """PRD-11."""
    s = inputs.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return reports.only_sources(s, list(s.agg(F.min("s_name"), F.max("s_name")).first()), "s_name")


@query(sql.ARTICLES + "SELECT source_name, seq FROM (SELECT source_name, seq, row_number() OVER (PARTITION BY source_name ORDER BY seq) AS r FROM articles) WHERE r <= 7")
def candidate_limit(spark, d):
    """LIM-2: the larger limit holds."""
    ranked = A.limit_each(inputs.articles(spark, d).select("source_name", "seq"), "source_name", ["seq"], 7)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("source_name").orderBy("seq")))
    return reports.candidates_of(ranked, 4, 7).select("source_name", "seq")


JUDGED = sql.DAYS + sql.BASELINE + sql.STREAK + ", judged AS (SELECT date".join(sql.ANOMALIES.rsplit("\nSELECT date", 1)) + ")\n"


@query(JUDGED + "SELECT row_number() OVER (ORDER BY CASE anomaly_level WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END DESC, source, date) AS position, date, source, anomaly_level FROM judged WHERE anomaly_level <> 'normal'")
def by_severity(spark, d):
    """SRT-3: the order as a number, over the day in the end."""
    rows = reports.by_severity(judged(spark, d))
    order = Window.orderBy(F.when(F.col("anomaly_level") == "critical", 2).when(F.col("anomaly_level") == "warning", 1).otherwise(0).desc(), "source", "date")  # rows that stand out only
    return rows.select(F.row_number().over(order).cast("long").alias("position"), "date", "source", "anomaly_level")


@query("SELECT CAST(event_id AS VARCHAR) AS id FROM (SELECT event_id FROM events WHERE event_id IS NOT NULL GROUP BY event_id ORDER BY event_id DESC LIMIT 10000)")
def remembered_attempts(spark, d):
    """JOI-10: the last 10,000 attempts in their order."""
    e = inputs.table(spark, d, "events").where("event_id IS NOT NULL").select(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("seq")).distinct()
    return reports.remember(e.where("seq % 3 = 0"), e, [F.col("seq")]).select("id")


@query("SELECT '2024-02-01T08' AS occurred_at, '2024-02-01' AS target_date, s_name AS source, 'https://x.example/' || CAST(s_suppkey AS VARCHAR) AS url, CASE WHEN s_suppkey % 2 = 0 THEN 'Timeout' ELSE '' END AS error_type, 'key ' || CAST(s_suppkey AS VARCHAR) AS error FROM supplier")
def error_records(spark, d):
    """SNK-8."""
    k = F.col("s_suppkey")
    rows = inputs.table(spark, d, "supplier").select(F.col("s_name").alias("source"), F.concat(F.lit("https://x.example/"), k.cast("string")).alias("url"), F.when(k % 2 == 0, "Timeout").alias("error_type"), F.concat(F.lit("key "), k.cast("string")).alias("error"))
    return reports.error_records(rows, F.lit("2024-02-01"), F.lit("2024-02-01T08"))


@query("""SELECT '{"generated_at":"2024-02-01T08","target_date":"2024-02-01","sources":[' || string_agg('{"name":"' || n_name || '","number":' || CAST(n_nationkey AS VARCHAR) || '}', ',' ORDER BY n_name, n_nationkey) || ']}' AS report FROM nation""")
def health_report(spark, d):
    """SNK-9."""
    n = inputs.table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("number"))
    return reports.health_report(n, F.lit("2024-02-01"), F.lit("2024-02-01T08"), ["name", "number"])


@query(STORED + "SELECT seq, CASE WHEN seq % 11 = 0 THEN 'missing' ELSE content_status END AS content_status FROM marked")
def stored_quality(spark, d):
    """SRC-5: challenge pages that were stored as articles count as missing."""
    return files.stored_quality(marked(spark, d)).select("seq", "content_status")


@query(STORED + "SELECT seq FROM marked WHERE seq % 11 <> 0")
def purge_challenges(spark, d):
    """SNK-15."""
    return files.purge_challenges(marked(spark, d)).select("seq")


@query(sql.ARTICLES + "SELECT url_key, max(length(trim(content, ' ' || chr(9) || chr(10) || chr(13)))) AS content_chars FROM articles GROUP BY url_key")
def longest_content(spark, d):
    """SRC-4."""
    return files.longest_content(dated(spark, d), F.col("url_key"))


@query(sql.ARTICLES + "SELECT DISTINCT url_key FROM articles WHERE content_status = 'full'")
def collected_urls(spark, d):
    """SRC-3: canonical addresses whose text is full."""
    return files.collected(dated(spark, d), F.col("url_key"))


@query(sql.ARTICLES + ", have AS (SELECT DISTINCT url_key FROM articles WHERE content_status = 'full') SELECT seq FROM articles WHERE url_key NOT IN (SELECT url_key FROM have)")
def skip_full(spark, d):
    """PRD-5: articles whose address is not collected in full."""
    rows = dated(spark, d)
    return A.not_collected(rows, files.collected(rows, F.col("url_key")), "url_key").select("seq")


@query(sql.ARTICLES + ", c AS (SELECT seq, 'https://x.example/' || CASE WHEN domain = 'en' THEN '' ELSE 'card/' END || CAST(seq AS VARCHAR) AS k, date FROM articles), f AS (SELECT 'https://x.example/' || CASE WHEN source_name <> 'src1' THEN '' ELSE 'entry/' END || CAST(seq AS VARCHAR) AS k, title FROM articles) SELECT c.k AS url, c.date AS published_date, f.title, true AS listed FROM c LEFT JOIN f USING (k) UNION ALL SELECT f.k || '#feed', NULL, f.title, false FROM f WHERE f.k NOT IN (SELECT k FROM c)")
def listing_with_feed(spark, d):
    """JOI-13, JOI-14: cards with their feed entry by address without fragment, and entries that no card names."""
    a, at = dated(spark, d), F.col("seq").cast("string")
    card = F.concat(F.lit("https://x.example/"), F.when(F.col("domain") == "en", "").otherwise("card/"), at)
    entry = F.concat(F.lit("https://x.example/"), F.when(F.col("source_name") != "src1", "").otherwise("entry/"), at)
    cards = a.select(card.alias("url"), F.col("date").alias("published_date"))
    entries = a.select(F.concat(entry, F.lit("#feed")).alias("url"), "title", F.lit("").alias("summary"))
    return feeds.with_feed_only(cards, entries).select("url", "published_date", "title", "listed")


def listed(values):
    """Texts as a list in SQL."""
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


BODY = sql.ARTICLES + rf""", c AS (
  SELECT seq, content || CASE seq % 5 WHEN 1 THEN chr(10) || 'Related Articles' || chr(10) || 'never kept here' WHEN 2 THEN chr(10) || '免责声明 x' || chr(10) || 'never kept here' WHEN 3 THEN chr(10) || '来源：some paper' || chr(10) || 'Tags one two' || chr(10) || 'a@b.cd is mail' ELSE '' END AS t FROM articles
), p AS (
  SELECT seq, trim(regexp_replace(regexp_replace(t, '[ 	]+', ' ', 'g'), '
{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM c
), s AS (
  SELECT seq, t, list_min(list_filter(list_transform({listed(text.STOP_MARKERS)}, lambda m: strpos(t, m)), lambda x: x > 1)) AS e FROM p
), l AS (
  SELECT seq, list_transform(string_split(CASE WHEN e IS NULL THEN t ELSE substr(t, 1, e - 1) END, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))) AS ls FROM s
), k AS (
  SELECT seq, ls, list_position(list_transform(ls, lambda x: len(list_filter({listed(text.LEGAL_LINES)}, lambda m: contains(x, m))) > 0), true) AS stop FROM l
)
SELECT seq, array_to_string(list_filter(CASE WHEN coalesce(stop, 0) > 0 THEN ls[1:stop - 1] ELSE ls END, lambda x: length(x) >= 8 AND NOT regexp_matches(x, '(?i)[\w.+-]+@[\w.-]+\.[a-z]{{2,}}')
  AND NOT regexp_matches(x, '(?i)^(?:[a-z0-9-]+\.)+[a-z]{{2,}}(?:/\S*)?$') AND NOT regexp_matches(x, '^[\d\s:/.\-年月日时分秒]+$')
  AND NOT regexp_matches(x, '(?i)^(?:source|from|author|by|published|updated|editor|copyright|tags?|share|newsletter|sign up|want more|your privacy choices|advertisement|sponsored|来源|来自|作者|记者|编辑|责任编辑|发布时间|发布日期|时间|关键词|标签|声明|版权|分享到|分享|打印|字号|阅读|浏览|打开网易新闻 查看精彩图片|上一篇|下一篇|相关|推荐|热门|更多)(?:[^\p{{L}}\p{{N}}\p{{M}}_]|$)')), chr(10)) AS body FROM k"""


@query(BODY)
def trimmed_bodies(spark, d):
    """TXT-5: bodies up to a stop marker or a legal line, without labels and addresses."""
    k = F.col("seq") % 5
    tail = F.when(k == 1, "\nRelated Articles\nnever kept here").when(k == 2, "\n免责声明 x\nnever kept here").when(k == 3, "\n来源：some paper\nTags one two\na@b.cd is mail").otherwise("")
    return inputs.articles(spark, d).select("seq", text.trim_body(F.concat("content", tail)).alias("body"))


@query(sql.ARTICLES + r"""SELECT seq, CASE WHEN source_name <> 'src1' OR title <> '' AND seq % 2 = 0 THEN CASE WHEN seq % 2 = 0 THEN title ELSE 'NE时代' END
  ELSE coalesce(left(list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')[1], 500), CASE WHEN seq % 2 = 0 THEN title ELSE 'NE时代' END) END AS title FROM articles""")
def repaired_titles(spark, d):
    """TXT-6: a channel's own name as title gives way to the first line of the text."""
    a = inputs.articles(spark, d)
    title = F.when(F.col("seq") % 2 == 0, F.col("title")).otherwise("NE时代")
    name = F.when(F.col("source_name") == "src1", " NE时代").otherwise(F.col("source_name"))
    return a.select("seq", text.repaired_title(title, F.col("content"), name).alias("title"))


@query(sql.ARTICLES + "SELECT date, count(*) AS rows FROM articles WHERE date IS NOT NULL GROUP BY date UNION ALL SELECT DATE '2031-01-01', 0")
def export_days(spark, d):
    """SRC-22: days of an export, the required one among them."""
    return reports.with_required_day(dated(spark, d), "date", F.lit("2031-01-01"))


@query(sql.ARTICLES + "SELECT domain, sub_domain, count(*) AS article_count FROM articles WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY domain, sub_domain")
def monthly_domains(spark, d):
    """SNK-13: one of the five sheets of a month."""
    from newsloom.operators import rollup

    rows = dated(spark, d).withColumn("summary_date", F.col("date")).withColumn("category", F.lit("")).withColumn("category_method", F.lit(""))
    month = rollup.in_window(rows, F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))
    return reports.monthly_sheets(month)["Domain Summary"]
