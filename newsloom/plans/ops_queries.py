"""Queries of the ledger, the queue and channel state, registered beside those of ``registry``."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.operators import articles as A
from newsloom.operators import audit, incidents, ledger, taxonomy
from newsloom.plans import inputs, sql
from newsloom.plans.registry import dated, query
from newsloom.sources import scratch
from newsloom.sources.store import Store

#: Fixed values in SQL: states that ask for something, and open and successful ones.
BAD, OPEN = "('failed', 'zero', 'degraded')", "('pending_confirmation', 'confirmed', 'recovering', 'recovery_failed')"
GOOD = "('healthy', 'already_collected', 'idle', 'recovered', 'verified_no_news')"

ATTEMPTS = sql.DAYS + sql.QUEUE + rf""", told AS (
  SELECT d.source, d.date, d.frequency, CASE WHEN d.crawl_status IN {BAD} AND q.status = 'recovered' THEN 'recovered' WHEN d.crawl_status IN {BAD} AND q.status = 'ignored' THEN 'verified_no_news' ELSE d.crawl_status END AS status,
    d.crawl_status, d.article_count, CASE WHEN d.article_count % 2 = 0 THEN '' ELSE 'HTTP 503; access_token=[REDACTED], x' END AS raw
  FROM days d LEFT JOIN queue q ON q.date = d.date AND q.source = d.source
), attempts AS (
  SELECT *, CASE WHEN status <> crawl_status THEN CASE status WHEN 'recovered' THEN '{ledger.SETTLED["recovered"]}' ELSE '{ledger.SETTLED["verified_no_news"]}' END ELSE raw END AS reason, CAST(date AS VARCHAR) || 'T08' AS tried_at FROM told
)
"""


def run_health(spark, d):
    """Health rows of every run: one for each channel and day of the statistics."""
    days, n = inputs.channel_days(spark, d), F.col("article_count")
    reason = F.when(n % 2 == 0, "").otherwise(F.concat(F.lit("HTTP 503; access_token=t"), n.cast("string"), F.lit(", x")))
    return days.select("source", "date", "frequency", F.col("crawl_status").alias("status"), reason.alias("reason"), n.alias("new_articles"), F.concat(F.col("date").cast("string"), F.lit("T08")).alias("generated_at"))


def attempts(spark, d):
    """Attempts of all runs, numbered by their day."""
    told = ledger.attempt_events(run_health(spark, d), inputs.incidents(spark, d), F.lit("now"))
    return told.withColumn("seq", F.unix_date("date").cast("long"))


@query(ATTEMPTS + r"""SELECT left(sha256(tried_at || chr(10) || CAST(date AS VARCHAR) || chr(10) || source || chr(10) || status || chr(10) || reason || chr(10) || CAST(article_count AS VARCHAR)), 24) AS id, date, source, status, reason, tried_at AS attempted_at FROM attempts""")
def ledger_attempts(spark, d):
    """STM-8, JOI-5: attempts as events; closed incidents have the last word on an unhealthy day."""
    return attempts(spark, d).select("id", "date", "source", "status", "reason", "attempted_at")


@query(ATTEMPTS + rf""", n AS (
  SELECT *, status IN {BAD} AS bad, lag(status) OVER w AS before, max(CASE WHEN NOT status IN {BAD} THEN date END) OVER (PARTITION BY source) AS healthy, max(date) OVER (PARTITION BY source) AS last_day FROM attempts WINDOW w AS (PARTITION BY source ORDER BY date)
), tail AS (
  SELECT source, count(*) FILTER (date > coalesce(healthy, DATE '1900-01-01')) AS streak, max(date) FILTER (status IN {GOOD}) AS ok FROM n GROUP BY source
), op AS (
  SELECT source, count(*) AS k, list(status) AS st FROM queue WHERE status IN {OPEN} GROUP BY source
)
SELECT n.source, n.frequency, n.date AS last_target_date, n.status AS last_status, coalesce(n.before, '') AS previous_status, n.tried_at AS last_attempt_at, CAST(tail.ok AS VARCHAR) || 'T08' AS last_success_at, tail.ok AS last_success_date,
  tail.streak AS consecutive_unhealthy, n.reason AS last_error, n.article_count AS new_articles, coalesce(op.k, 0) AS open_incidents,
  CASE WHEN list_contains(st, 'recovery_failed') THEN 'repair_then_reconfirm' WHEN list_contains(st, 'confirmed') OR list_contains(st, 'recovering') THEN 'automatic_backfill' WHEN list_contains(st, 'pending_confirmation') THEN 'repair_then_confirm' WHEN n.status IN {BAD} THEN 'investigate' ELSE 'none' END AS next_action
FROM n JOIN tail USING (source) LEFT JOIN op USING (source) WHERE n.date = n.last_day""")
def ledger_replay(spark, d):
    """STM-7, WIN-6, STM-6: channel state as the fold of the whole ledger, with open incidents and the next action."""
    state = ledger.with_incidents(ledger.replay(attempts(spark, d)), inputs.incidents(spark, d))
    return state.select("source", "frequency", "last_target_date", "last_status", "previous_status", "last_attempt_at", "last_success_at", "last_success_date", "consecutive_unhealthy", "last_error", "new_articles", "open_incidents", "next_action")


AUDITED = sql.DAYS + sql.SUMMARY + r""", audited AS (SELECT date FROM summary WHERE total_articles % 3 <> 0), ends AS (SELECT min(date) AS lo, max(date) AS hi FROM audited),
missing AS (SELECT CAST(unnest(generate_series(greatest(lo, hi - 31), hi - 1, INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
profile AS (SELECT source, min(CASE WHEN crawl_status <> 'historical' THEN date END) AS active_from, arg_max(frequency, date) AS frequency, arg_max(crawl_status, date) AS status FROM days GROUP BY source),
gaps AS (SELECT m.date, p.source, p.frequency FROM profile p JOIN missing m ON m.date >= p.active_from WHERE m.date NOT IN (SELECT date FROM audited) AND p.status <> 'skipped'
  AND (p.frequency = '每日' OR p.frequency = '工作日' AND isodow(m.date) <= 5) AND NOT EXISTS (SELECT 1 FROM days i WHERE i.date = m.date AND i.source = p.source AND i.article_count > 0))
"""


def gap_days(spark, d):
    """Days without a run, where the days whose total is divisible by three have no audit."""
    days = inputs.channel_days(spark, d)
    summary = audit.daily_summary(days).withColumn("sources_configured", F.when(F.col("total_articles") % 3 == 0, 0).otherwise(F.col("sources_configured")))
    latest = summary.where("sources_configured > 0").agg(F.max("date")).first()[0]
    return audit.missing_runs(days, summary, days, latest=F.lit(latest).cast("date"))


@query(AUDITED + r"""SELECT left(sha256('missing_run' || chr(10) || CAST(date AS VARCHAR) || chr(10) || source), 24) AS id, date, source, 'missing_run' AS status, 'MissingRunRecord' AS error_type, frequency FROM gaps""")
def missing_run_events(spark, d):
    """STM-7, JOI-8: runs that are missing, as events of the ledger."""
    return ledger.missing_events(gap_days(spark, d), F.lit("now")).select("id", "date", "source", "status", "error_type", "frequency")


@query(AUDITED + sql.QUEUE + rf""", cells AS (
  SELECT date, source, frequency, crawl_status, article_count, expected_daily, '' AS reason FROM days WHERE NOT EXISTS (SELECT 1 FROM gaps g WHERE g.date = days.date AND g.source = days.source)
  UNION ALL SELECT date, source, frequency, 'failed', 0, true, 'missing run record' FROM gaps
), s AS (
  SELECT *, CAST(date AS VARCHAR) || '::' || source AS id, article_count = 0 AND expected_daily AND crawl_status IN ('zero', 'failed') AS bad,
    CASE WHEN crawl_status <> 'failed' THEN 'no_candidates' WHEN reason <> '' THEN 'missing_run_record' ELSE 'fetch_failed' END AS code FROM cells
), b AS (
  SELECT coalesce(q.id, s.id) AS id, q.status AS qs, q.id IS NOT NULL AS known, coalesce(s.bad, false) AS bad, s.article_count > 0 AND q.status IN {OPEN} AS rec, s.code, q.diagnosis_code AS qd, s.article_count AS n, q.updated_at AS qu FROM s FULL JOIN queue q ON q.id = s.id
), c AS (
  SELECT id, CASE WHEN rec THEN 'recovered' WHEN known THEN qs ELSE 'pending_confirmation' END AS status, CASE WHEN bad THEN code ELSE qd END AS diagnosis_code, CASE WHEN rec THEN n ELSE 0 END AS recovered_articles, CASE WHEN rec THEN 'now' ELSE '' END AS recovered_at,
    CASE WHEN NOT known THEN 'now' END AS detected_at, CASE WHEN bad OR rec THEN 'now' ELSE qu END AS u FROM b WHERE known OR bad
)
SELECT id, CASE WHEN status = 'pending_confirmation' AND diagnosis_code = 'missing_run_record' THEN 'confirmed' ELSE status END AS status, diagnosis_code, recovered_articles, recovered_at, detected_at,
  CASE WHEN status = 'pending_confirmation' AND diagnosis_code = 'missing_run_record' THEN '{incidents.AUTO_NOTE}' ELSE '' END AS confirmation_note, CASE WHEN status = 'pending_confirmation' AND diagnosis_code = 'missing_run_record' THEN 'now' ELSE u END AS updated_at FROM c""")
def reconciled_queue(spark, d):
    """JOI-3, STM-3: the queue after all days and gaps, each with its own reason; late articles close old incidents."""
    gaps = gap_days(spark, d).withColumn("crawl_status", F.lit("failed")).withColumn("article_count", F.lit(0).cast("long")).withColumn("expected_daily", F.lit(True))
    days = inputs.channel_days(spark, d).join(gaps.select("date", "source"), ["date", "source"], "left_anti")
    cells = incidents.padded(days, incidents.CELL).unionByName(incidents.padded(gaps, incidents.CELL))
    reasons = gaps.select("date", "source", F.lit(ledger.MISSING_REASON).alias("reason"))
    queue = incidents.auto_confirm(incidents.sync_days(cells, inputs.incidents(spark, d), reasons, F.lit("now")), F.lit("now"))
    return queue.select("id", "status", "diagnosis_code", "recovered_articles", "recovered_at", "detected_at", F.coalesce("confirmation_note", F.lit("")).alias("confirmation_note"), "updated_at")


@query(sql.DAYS + sql.QUEUE + rf""", t AS (
  SELECT q.*, coalesce(d.article_count, 0) AS n, CASE WHEN (day(q.date) + length(q.source)) % 4 = 0 THEN 1 ELSE 0 END AS code, CASE WHEN (day(q.date) + length(q.source)) % 8 = 0 THEN 'no route' ELSE '' END AS said, q.status IN ('confirmed', 'recovering') AS tried
  FROM queue q LEFT JOIN days d ON d.date = q.date AND d.source = q.source
)
SELECT id, CASE WHEN tried THEN CASE WHEN n > 0 AND code = 0 THEN 'recovered' ELSE 'recovery_failed' END ELSE status END AS status, attempts + CASE WHEN tried THEN 1 ELSE 0 END AS attempts, CASE WHEN tried AND n > 0 AND code = 0 THEN n ELSE recovered_articles END AS recovered_articles,
  CASE WHEN tried THEN CASE WHEN n > 0 AND code = 0 THEN '' WHEN said <> '' THEN said WHEN code <> 0 THEN '补抓命令退出码为 1' ELSE '{incidents.STILL_EMPTY}' END END AS last_error, CASE WHEN tried THEN 'now' END AS last_attempt_at FROM t""")
def recovery_attempts(spark, d):
    """STM-4: a backfill in two steps, over the articles that are there afterwards and what the attempts report."""
    queue = incidents.padded(inputs.incidents(spark, d), incidents.INCIDENT)
    k = F.dayofmonth("date") + F.length("source")
    outcomes = queue.select("id", F.when(k % 4 == 0, 1).otherwise(0).alias("exit_code"), F.when(k % 8 == 0, "no route").alias("reason"))
    done = incidents.end_recovery(incidents.begin_recovery(queue, F.lit("now")), inputs.channel_days(spark, d), F.lit("now"), outcomes)
    return done.select("id", "status", "attempts", "recovered_articles", "last_error", "last_attempt_at")


@query(sql.ARTICLES + sql.WORTH + """, b AS (
  SELECT url_key, seq % 4 >= 2 AS late, content, content_status, cls, tier, w FROM worth QUALIFY row_number() OVER (PARTITION BY url_key, seq % 4 >= 2 ORDER BY tier DESC, w DESC, seq) = 1
), o AS (SELECT * FROM b WHERE NOT late), n AS (SELECT * FROM b WHERE late),
m AS (SELECT coalesce(o.url_key, n.url_key) AS url_key, o.url_key IS NULL AS fresh, n.url_key IS NOT NULL AND (o.url_key IS NULL OR n.tier > o.tier OR n.tier = o.tier AND n.w > o.w) AS wins, o.content AS oc, n.content AS nc, o.content_status AS os, n.content_status AS ns, o.cls AS ol, n.cls AS nl FROM o FULL JOIN n ON o.url_key = n.url_key)
SELECT url_key, md5(CASE WHEN wins THEN nc ELSE oc END) AS digest, CASE WHEN wins THEN ns ELSE os END AS content_status, CASE WHEN wins AND (fresh OR nl IN ('classified', 'unclassified') OR nl = 'error' AND ol NOT IN ('classified', 'unclassified')) THEN nl ELSE ol END AS classification FROM m""")
def stored_articles(spark, d):
    """SNK-2, DED-2: a stored table after two batches, of which the second changes what is better and adds what is new."""
    rows = dated(spark, d).select("url_key", "seq", "content", "content_status", "industry_classification_status")
    table = Store(spark, scratch.fresh(spark, "articles"), "url_key", buckets=8)
    for late in (False, True):
        table.put(rows.where((F.col("seq") % 4 >= 2) == late).withColumnRenamed("seq", "_seq"))
    return table.read().select("url_key", F.md5("content").alias("digest"), "content_status", F.col("industry_classification_status").alias("classification"))


@query(sql.ARTICLES.replace("WITH base", "WITH RECURSIVE base") + sql.WORTH + """, m AS (
  SELECT seq, seq // 10 AS key, tier, w, CASE content_status WHEN 'full' THEN 3 WHEN 'incomplete' THEN 2 WHEN 'missing' THEN 0 ELSE 1 END AS rank, seq % 3 = 0 AS open_, seq % 3 <> 0 AND seq % 5 <> 0 AS titled, row_number() OVER (PARTITION BY seq // 10 ORDER BY seq) AS n FROM worth
), walk AS (
  SELECT * FROM m WHERE n = 1
  UNION ALL
  SELECT CASE WHEN b THEN m.seq ELSE x.seq END, x.key, CASE WHEN b THEN m.tier ELSE x.tier END, CASE WHEN b THEN m.w ELSE x.w END, CASE WHEN b THEN m.rank ELSE x.rank END, CASE WHEN b THEN m.open_ ELSE x.open_ END, CASE WHEN b THEN m.titled ELSE x.titled END, m.n
  FROM (SELECT w.*, w.open_ AND m.titled AND m.rank >= w.rank OR m.tier > w.tier OR m.tier = w.tier AND m.w > w.w AS b FROM walk w JOIN m ON m.key = w.key AND m.n = w.n + 1) x JOIN m ON m.key = x.key AND m.n = x.n + 1
)
SELECT key, arg_max(seq, n) AS seq FROM walk GROUP BY key""")
def folded_articles(spark, d):
    """DED-1 with placeholders: every third record is titled by its channel's name, every fifth other one not at all."""
    k = F.col("seq")
    rows = dated(spark, d).select(F.floor(k / 10).alias("key"), "seq", "content_status", "content", F.when(k % 3 == 0, "NE时代 ").when(k % 5 == 0, "").otherwise("A title").alias("title"), F.lit("ne时代").alias("source_name"))
    return A.fold_best(rows, "key", "seq", "source_name", "ne时代").select("key", "seq")


@query(sql.ARTICLES + """, leaf AS (SELECT DISTINCT domain || ' > ' || source_name || ' > ' || sub_domain AS path FROM articles),
allowed AS (SELECT DISTINCT domain || ' > ' || source_name || ' > ' || sub_domain AS path FROM articles WHERE content_status = 'full' UNION SELECT DISTINCT domain || ' > ' || source_name FROM articles WHERE seq % 50 = 0)
SELECT 'missing' AS kind, path FROM leaf WHERE path NOT IN (SELECT path FROM allowed) UNION ALL SELECT 'extra', path FROM allowed WHERE path NOT IN (SELECT path FROM leaf)""")
def taxonomy_gaps(spark, d):
    """JOI-17, SET-2: leaves of a tree of topics (domain, channel, sub-domain of all articles) against a taxonomy."""
    a = inputs.articles(spark, d).select("seq", "domain", "source_name", "sub_domain", "content_status")
    channel, leaf = F.concat_ws("/", "domain", "source_name"), F.concat_ws("/", "domain", "source_name", "sub_domain", F.lit("."))
    roots = a.select(F.col("domain").alias("topic"), F.lit(None).cast("string").alias("parent"), F.col("domain").alias("title"))
    topics = roots.unionByName(a.select(channel.alias("topic"), F.col("domain").alias("parent"), F.col("source_name").alias("title")))
    topics = topics.unionByName(a.select(leaf.alias("topic"), channel.alias("parent"), F.col("sub_domain").alias("title"))).distinct()
    allowed = a.where("content_status = 'full'").select(F.array("domain", "source_name", "sub_domain").alias("path"))
    allowed = allowed.unionByName(a.where("seq % 50 = 0").select(F.array("domain", "source_name").alias("path")))
    return taxonomy.compare(taxonomy.leaves_of(topics), allowed)
