"""DuckDB SQL that the statements of the registry share: inputs and steps as named parts of a WITH clause."""

ARTICLES = r"""WITH base AS (
  SELECT *, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS day, CASE WHEN doc_id % 7 = 0 THEN doc_id // 14 * 14 ELSE doc_id END AS number FROM documents
), articles AS (
  SELECT doc_id AS seq, substr(split_part(text, chr(10), 1), 1, 60) AS title, text AS content, day,
    CASE WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 3 = 0 THEN day END WHEN doc_id % 4 = 2 THEN day + 1 ELSE day END AS date,
    ['full', '', 'incomplete', 'missing', 'unknown'][doc_id % 5 + 1] AS content_status, ['', 'dom', 'rss_excerpt', 'public_preview', 'dom', 'dom'][doc_id % 6 + 1] AS content_extraction,
    'http://www.Example.com/' || source || '/' || CASE WHEN doc_id % 3 = 0 THEN strftime(day, '%Y/%m/%d') ELSE 'news' END || '/' || CAST(number AS VARCHAR) || '.html?utm_source=feed&b=2&a=1#top' AS url,
    'https://example.com/' || source || '/' || CASE WHEN doc_id % 3 = 0 THEN strftime(day, '%Y/%m/%d') ELSE 'news' END || '/' || CAST(number AS VARCHAR) || '.html?a=1&b=2' AS url_key,
    source AS source_name, lang AS domain, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE '' END AS sub_domain,
    ['classified', '', 'error', 'unclassified'][doc_id % 4 + 1] AS cls, 'v' || CAST(doc_id % 3 AS VARCHAR) AS version
  FROM base
)
"""

INVENTORY = r""", sized AS (
  SELECT date, source_name AS source, url_key, length(trim(content, ' ' || chr(9) || chr(10) || chr(13))) AS chars,
    CASE WHEN content_status <> '' THEN content_status ELSE 'unknown' END AS status FROM articles WHERE date IS NOT NULL
), inventory AS (
  SELECT date, source, count(*) AS article_count, count(DISTINCT url_key) AS unique_articles, count(*) - count(DISTINCT url_key) AS duplicate_articles,
    count(*) FILTER (status = 'full') AS usable_articles, count(*) FILTER (status <> 'full') AS incomplete_articles, count(*) FILTER (chars < 500) AS short_articles,
    min(chars) AS content_chars_min, CAST(trunc(quantile_cont(chars, 0.5)) AS BIGINT) AS content_chars_median, max(chars) AS content_chars_max FROM sized GROUP BY date, source
)
"""

ASSESSED = r""", cases AS (
  SELECT seq, content_extraction AS m, CASE WHEN seq % 9 = 6 THEN '' ELSE trim(content || CASE seq % 9 WHEN 1 THEN ' Subscribe to read more' WHEN 2 THEN ' and so on...' WHEN 3 THEN ' Read More ' WHEN 4 THEN ' verify you are human, cloudflare' WHEN 5 THEN ' 登录后阅读全文' ELSE '' END, ' ' || chr(10)) END AS t FROM articles
), ruled AS (
  SELECT seq, CASE WHEN t = '' THEN 1 WHEN lower(t) LIKE '%verify you are human%' AND lower(t) LIKE '%cloudflare%' THEN 2 WHEN lower(t) LIKE '%subscribe to read%' OR t LIKE '%登录后阅读全文%' THEN 3
    WHEN regexp_matches(t, '(?i)(\.{3}|…|read more|continue reading|阅读全文)\s*$') THEN 4 WHEN m = 'rss_excerpt' THEN 5 WHEN m = 'public_preview' THEN 6 WHEN m <> '' THEN 7 ELSE 8 END AS r FROM cases
), assessed AS (
  SELECT seq, ['missing', 'missing', 'incomplete', 'incomplete', 'incomplete', 'incomplete', 'full', 'unknown'][r] AS status,
    ['empty_content', 'access_challenge', 'paywall_or_login_wall', 'truncated_ending', 'rss_excerpt_only', 'public_preview_only', '', 'legacy_record_not_verified'][r] AS issue FROM ruled
)
"""

WORTH = r""", worth AS (
  SELECT *, CASE content_status WHEN 'full' THEN 2 WHEN 'missing' THEN 0 ELSE 1 END AS tier, CASE content_status WHEN 'missing' THEN 0 ELSE length(trim(content, ' ' || chr(9) || chr(10) || chr(13))) END AS w FROM articles
)
"""

DAYS = r"""WITH RECURSIVE ev AS (
  SELECT CAST(ts AS DATE) AS date, event_type || '-' || CAST(user_id % 5 AS VARCHAR) AS source, event_id FROM events
), counted AS (
  SELECT date, source, count(*) AS n, sum(CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END) AS u, count(DISTINCT event_id % 97) AS d FROM ev GROUP BY date, source
), keyed AS (
  SELECT *, day(date) * 7 + length(source) * 3 + n AS k, CASE WHEN source LIKE '%-0' THEN '工作日' WHEN source LIKE '%-1' THEN '每周' ELSE '每日' END AS frequency FROM counted
), days AS (
  SELECT date, source, CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE n END AS BIGINT) AS article_count, CAST(least(u, CASE WHEN k % 5 = 0 THEN 0 ELSE n END) AS BIGINT) AS usable_articles,
    CAST(greatest(CASE WHEN k % 5 = 0 THEN 0 ELSE n END - d, 0) AS BIGINT) AS duplicate_articles, frequency,
    CASE WHEN k % 13 = 0 THEN 'failed' WHEN k % 17 = 0 THEN 'skipped' WHEN k % 5 = 0 OR n = 0 THEN 'zero' WHEN k % 19 = 0 THEN 'historical' ELSE 'healthy' END AS crawl_status,
    frequency = '每日' OR frequency = '工作日' AND isodow(date) <= 5 AS expected_daily
  FROM keyed WHERE k % 11 <> 0
)
"""

BASELINE = r""", windowed AS (
  SELECT *, round_even(quantile_cont(article_count, 0.5) OVER w, 2) AS baseline_median_7d, last_value(article_count) OVER w AS previous_count FROM days
  WINDOW w AS (PARTITION BY source ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
), based AS (
  SELECT *, CASE WHEN baseline_median_7d > 0 THEN round_even(article_count / baseline_median_7d, 2) END AS ratio_to_baseline FROM windowed
)
"""

_WALK = r""", walk(source, date, back, streak) AS (
  SELECT source, date, date - 1, 1 FROM days WHERE article_count = 0
  UNION ALL
  SELECT w.source, w.date, w.back - 1, w.streak + CASE WHEN r.expected_daily THEN 1 ELSE 0 END FROM walk w JOIN days r ON r.source = w.source AND r.date = w.back
  WHERE w.back >= w.date - 7 AND (NOT r.expected_daily OR r.article_count = 0)
), streaks AS (
  SELECT source, date, max(streak) AS streak FROM walk GROUP BY source, date
)
"""
STREAK = _WALK
STREAK_ONLY = _WALK + "SELECT d.date, d.source, coalesce(s.streak, 0) AS zero_streak_days FROM days d LEFT JOIN streaks s ON s.source = d.source AND s.date = d.date"

ANOMALIES = r""", m AS (
  SELECT b.*, coalesce(s.streak, 0) AS zero_streak_days, CASE WHEN article_count <> 0 THEN round_even(usable_articles / article_count, 4) ELSE 0.0 END AS usable_rate, article_count AS c, baseline_median_7d AS base, ratio_to_baseline AS r,
    crawl_status <> 'skipped' AND expected_daily AS watched, coalesce(previous_count > 0, false) OR coalesce(baseline_median_7d > 0, false) AS had FROM based b LEFT JOIN streaks s ON s.source = b.source AND s.date = b.date
), f AS (
  SELECT *, [CASE WHEN crawl_status = 'failed' THEN 'fetch_failed' END, CASE WHEN watched AND c = 0 AND had THEN 'sudden_zero' END, CASE WHEN watched AND c = 0 AND NOT had THEN 'no_output' END,
    CASE WHEN watched AND c = 0 AND zero_streak_days >= 2 THEN 'zero_2d' END, CASE WHEN watched AND c > 0 AND base > 0 AND r >= 2 AND c - base >= 5 THEN 'surge_2x' END, CASE WHEN watched AND c > 0 AND base > 0 AND r <= 0.35 AND base - c >= 3 THEN 'sharp_drop' END,
    CASE WHEN c >= 2 AND usable_rate < 0.7 THEN 'low_usable_rate' END, CASE WHEN c >= 3 AND duplicate_articles / c >= 0.2 THEN 'duplicate_spike' END] AS codes FROM m
)
SELECT date, source, article_count, usable_rate, previous_count, baseline_median_7d, ratio_to_baseline, zero_streak_days, array_to_string(list_filter(codes, lambda x: x IS NOT NULL), ',') AS anomaly_codes,
  CASE WHEN list_has_any(codes, ['fetch_failed', 'sudden_zero', 'zero_2d']) OR list_contains(codes, 'surge_2x') AND r >= 4 THEN 'critical' WHEN len(list_filter(codes, lambda x: x IS NOT NULL)) > 0 THEN 'warning' ELSE 'normal' END AS anomaly_level FROM f
"""

SUMMARY = r""", summary AS (
  SELECT date, count(*) AS sources_configured, count(*) FILTER (crawl_status <> 'skipped') AS sources_active, count(*) FILTER (article_count > 0) AS sources_with_articles, count(*) FILTER (crawl_status = 'healthy') AS healthy_sources,
    count(*) FILTER (crawl_status <> 'skipped' AND expected_daily AND article_count = 0) AS zero_sources, count(*) FILTER (crawl_status = 'idle') AS idle_sources, count(*) FILTER (crawl_status = 'failed') AS failed_sources,
    CAST(sum(article_count) AS BIGINT) AS total_articles, CAST(sum(usable_articles) AS BIGINT) AS usable_articles FROM days GROUP BY date
)
"""

SUMMARY_ANOMALIES = r""", w AS (
  SELECT *, round_even(quantile_cont(total_articles, 0.5) OVER (ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 2) AS b FROM summary
), v AS (
  SELECT *, CASE WHEN b > 0 THEN round_even(total_articles / b, 2) END AS r, CASE WHEN total_articles <> 0 THEN round_even(usable_articles / total_articles, 4) ELSE 0.0 END AS q, total_articles AS t FROM w
), f AS (
  SELECT *, [CASE WHEN t = 0 THEN 'overall_zero' END, CASE WHEN t <> 0 AND b > 0 AND r >= 2 AND t - b >= 20 THEN 'overall_surge' END, CASE WHEN t <> 0 AND b > 0 AND r <= 0.5 AND b - t >= 10 THEN 'overall_drop' END, CASE WHEN failed_sources > 0 THEN 'source_failures' END,
    CASE WHEN sources_active > 0 AND zero_sources / sources_active >= 0.25 THEN 'many_zero_sources' END, CASE WHEN t >= 5 AND q < 0.7 THEN 'overall_low_quality' END] AS codes FROM v
)
SELECT date, b AS baseline_median_7d, r AS ratio_to_baseline, q AS usable_rate, array_to_string(list_filter(codes, lambda x: x IS NOT NULL), ',') AS anomaly_codes,
  CASE WHEN list_has_any(codes, ['overall_zero', 'source_failures']) OR list_contains(codes, 'overall_surge') AND r >= 3 OR list_contains(codes, 'overall_drop') AND r <= 0.2 THEN 'critical' WHEN len(list_filter(codes, lambda x: x IS NOT NULL)) > 0 THEN 'warning' ELSE 'normal' END AS anomaly_level FROM f
"""

QUEUE = r""", queue AS (
  SELECT CAST(date AS VARCHAR) || '::' || source AS id, date, source, ['pending_confirmation', 'confirmed', 'recovering', 'recovered', 'recovery_failed', 'ignored'][(day(date) + length(source) + article_count) % 6 + 1] AS status,
    (day(date) + length(source) + article_count) % 3 AS attempts, CAST(0 AS BIGINT) AS recovered_articles, CASE WHEN (day(date) + length(source) + article_count) % 2 = 0 THEN 'missing_run_record' ELSE 'timeout' END AS diagnosis_code, '2024-02-01' AS updated_at
  FROM days WHERE crawl_status NOT IN ('healthy', 'zero')
)
"""

HEALTH = r""", last_days AS (
  SELECT source, max(date) AS date, arg_max(frequency, date) AS frequency, arg_max(crawl_status, date) AS status, arg_max(article_count, date) AS new_articles FROM days GROUP BY source
), health AS (
  SELECT source, date, frequency, status, ['', 'HTTP 403 Forbidden', 'Read timed out', 'HTTP 503 bad gateway', 'selector not found; api_key=abc123, x', 'missing run record'][(new_articles + length(source)) % 6 + 1] AS reason,
    (new_articles + length(source)) % 3 AS candidates_seen, (new_articles + length(source)) % 2 AS pages_fetched, new_articles FROM last_days
)
"""

DIAGNOSED = r""", diagnosed AS (
  SELECT d.date, d.source, CASE WHEN d.crawl_status = 'failed' THEN CASE h.reason WHEN 'missing run record' THEN 'missing_run_record' WHEN 'HTTP 403 Forbidden' THEN 'access_denied' WHEN 'Read timed out' THEN 'timeout' WHEN 'HTTP 503 bad gateway' THEN 'upstream_unavailable'
    WHEN 'selector not found; api_key=abc123, x' THEN 'entry_not_found' ELSE 'fetch_failed' END WHEN coalesce(h.candidates_seen, 0) = 0 THEN 'no_candidates' WHEN coalesce(h.pages_fetched, 0) = 0 THEN 'candidates_filtered' ELSE 'no_target_articles' END AS code
  FROM days d LEFT JOIN health h ON h.source = d.source
)
"""
