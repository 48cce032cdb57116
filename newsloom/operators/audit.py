"""The daily audit: inventory, seven-day baselines, zero streaks, anomalies, volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.channels import expects_on
from newsloom.functions.text import assess, present, strip
from newsloom.operators.reports import audited_days

DAY = 86_400


def inventory(articles: DataFrame, date: str, url_key: str, min_chars: int = 500) -> DataFrame:
    """Counts per (date, source): articles, distinct addresses, usable and short texts, lengths.

    Rows without a date or a channel are left out. A blank status is assessed from the text. The median length is cut
    to an integer. One shuffle on the two keys; the distinct count adds a partial one on the address.
    """
    rows = articles.where(F.col(date).isNotNull() & (strip(present("source_name")) != ""))
    status = F.when(present("content_status") != "", F.lower("content_status")).otherwise(assess(F.col("content"))["status"])
    rows = rows.select(F.col(date).alias("date"), strip(F.col("source_name")).alias("source"), F.nullif(F.col(url_key), F.lit("")).alias("key"), status.alias("status"), F.length(strip(present("content"))).alias("chars"))
    counts = rows.groupBy("date", "source").agg(
        F.count("*").alias("article_count"),
        F.countDistinct("key").alias("unique_articles"),
        F.sum((F.col("status") == "full").cast("long")).alias("usable_articles"),
        F.sum((F.col("status") != "full").cast("long")).alias("incomplete_articles"),
        F.sum((F.col("chars") < min_chars).cast("long")).alias("short_articles"),
        F.min("chars").cast("long").alias("content_chars_min"),
        F.percentile("chars", 0.5).cast("long").alias("content_chars_median"),
        F.max("chars").cast("long").alias("content_chars_max"),
    )
    return counts.withColumn("duplicate_articles", F.greatest(F.col("article_count") - F.col("unique_articles"), F.lit(0).cast("long")))


def daily_totals(inventory: DataFrame) -> DataFrame:
    """Sums per date; distinct addresses are summed over channels."""
    names = ["article_count", "unique_articles", "duplicate_articles", "usable_articles", "incomplete_articles", "short_articles"]
    return inventory.groupBy("date").agg(*(F.sum(n).alias(n.replace("article_count", "total_articles")) for n in names))


def volume_pivot(inventory: DataFrame, sources: list[str]) -> DataFrame:
    """Date by channel; null where nothing is known."""
    return inventory.groupBy("date").pivot("source", sources).agg(F.first("article_count"))


def prior_week(*by: str) -> Window:
    """The seven calendar days before a row's; days without a row are absent, not zero."""
    return Window.partitionBy(*by).orderBy(F.unix_date("date")).rangeBetween(-7, -1)


def ratio(value: Column, baseline: Column) -> Column:
    return F.when(baseline > 0, F.bround(value / baseline, 2))


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.bround(part / whole, 4)).otherwise(F.lit(0.0))


def with_baseline(rows: DataFrame, count: str, *by: str) -> DataFrame:
    """Adds the median, the last count and the ratio over the seven days before."""
    week = prior_week(*by)
    rows = rows.withColumn("baseline_median_7d", F.bround(F.percentile(count, 0.5).over(week), 2)).withColumn("previous_count", F.last(count).over(week))
    return rows.withColumn("ratio_to_baseline", ratio(F.col(count), F.col("baseline_median_7d")))


def zero_streak(rows: DataFrame, count: str = "article_count", frequency: str = "frequency") -> DataFrame:
    """Adds ``zero_streak_days``: days in a row without articles, today's included, going back a week at most.

    Days on which the channel is not expected, by that day's frequency or else today's, are passed over; a day without
    a row ends the streak.
    """
    day = F.unix_date("date")
    before = F.collect_list(F.struct(day.alias("d"), F.col(count).alias("n"), present(frequency).alias("f"))).over(prior_week("source"))
    walk = F.aggregate(
        F.reverse("_before"),
        F.struct(F.lit(1).alias("streak"), (day - 1).alias("at"), F.lit(True).alias("on")),
        lambda a, r: F.when(~a["on"] | (r["d"] != a["at"]), F.struct(a["streak"].alias("streak"), a["at"].alias("at"), F.lit(False).alias("on")))
        .when(~expects_on(F.when(r["f"] != "", r["f"]).otherwise(present(frequency)), F.date_from_unix_date(r["d"])), F.struct(a["streak"].alias("streak"), (a["at"] - 1).alias("at"), F.lit(True).alias("on")))
        .when(r["n"] != 0, F.struct(a["streak"].alias("streak"), a["at"].alias("at"), F.lit(False).alias("on")))
        .otherwise(F.struct((a["streak"] + 1).alias("streak"), (a["at"] - 1).alias("at"), F.lit(True).alias("on"))),
        lambda a: a["streak"],
    )
    rows = rows.withColumn("_before", before)
    return rows.withColumn("zero_streak_days", F.when(F.col(count) != 0, 0).otherwise(walk)).drop("_before")


def _verdict(rows: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """Codes of the rules that hold, in their order, and the worst of their levels (0 normal, 1 warning, 2 critical)."""
    codes = F.array_compact(F.array(*(F.when(holds, F.lit(code)) for code, holds, _ in rules)))
    level = F.greatest(*(F.when(holds, level).otherwise(0) for _, holds, level in rules))
    return rows.withColumn("anomaly_codes", F.array_join(codes, ",")).withColumn("anomaly_level", F.element_at(F.array(F.lit("normal"), F.lit("warning"), F.lit("critical")), level + 1))


def channel_anomalies(rows: DataFrame) -> DataFrame:
    """Rules about one channel's day; needs counts, baseline, streak, ``crawl_status`` and ``expected_daily``.

    Fixed values: the codes, their levels and thresholds.
    """
    c, base, r, prev = (F.col(x) for x in ("article_count", "baseline_median_7d", "ratio_to_baseline", "previous_count"))
    watched = (F.col("crawl_status") != "skipped") & F.col("expected_daily")
    had = F.coalesce(prev > 0, F.lit(False)) | F.coalesce(base > 0, F.lit(False))
    zero, some = watched & (c == 0), watched & (c > 0) & F.coalesce(base > 0, F.lit(False))
    rows = rows.withColumn("usable_rate", rate(F.col("usable_articles"), c))
    return _verdict(
        rows,
        [
            ("fetch_failed", F.col("crawl_status") == "failed", F.lit(2)),
            ("sudden_zero", zero & had, F.lit(2)),
            ("no_output", zero & ~had, F.lit(1)),
            ("zero_2d", zero & (F.col("zero_streak_days") >= 2), F.lit(2)),
            ("surge_2x", some & (r >= 2) & (c - base >= 5), F.when(r >= 4, 2).otherwise(1)),
            ("sharp_drop", some & (r <= 0.35) & (base - c >= 3), F.lit(1)),
            ("low_usable_rate", (c >= 2) & (F.col("usable_rate") < 0.7), F.lit(1)),
            ("duplicate_spike", (c >= 3) & (F.col("duplicate_articles") / c >= 0.2), F.lit(1)),
        ],
    )


def daily_summary(stats: DataFrame) -> DataFrame:
    """Channels by state and sums per date."""
    s, n, expected = F.col("crawl_status"), F.col("article_count"), F.col("expected_daily")
    count = lambda holds: F.sum(F.when(holds, 1).otherwise(0)).cast("long")
    return stats.groupBy("date").agg(
        F.count("*").alias("sources_configured"),
        count(s != "skipped").alias("sources_active"),
        count(n > 0).alias("sources_with_articles"),
        count(s == "healthy").alias("healthy_sources"),
        count((s != "skipped") & expected & (n == 0)).alias("zero_sources"),
        count(s == "idle").alias("idle_sources"),
        count(s == "failed").alias("failed_sources"),
        F.sum("article_count").alias("total_articles"),
        F.sum("usable_articles").alias("usable_articles"),
    )


def summary_anomalies(summary: DataFrame) -> DataFrame:
    """Rules about all channels' day. The baseline is over one row a day, so its window is one small partition.

    Fixed values: the codes, their levels and thresholds.
    """
    rows = with_baseline(summary, "total_articles").withColumn("usable_rate", rate(F.col("usable_articles"), F.col("total_articles")))
    t, base, r, active = (F.col(x) for x in ("total_articles", "baseline_median_7d", "ratio_to_baseline", "sources_active"))
    some = (t != 0) & F.coalesce(base > 0, F.lit(False))
    return _verdict(
        rows,
        [
            ("overall_zero", t == 0, F.lit(2)),
            ("overall_surge", some & (r >= 2) & (t - base >= 20), F.when(r >= 3, 2).otherwise(1)),
            ("overall_drop", some & (r <= 0.5) & (base - t >= 10), F.when(r <= 0.2, 2).otherwise(1)),
            ("source_failures", F.col("failed_sources") > 0, F.lit(2)),
            ("many_zero_sources", (active > 0) & (F.col("zero_sources") / active >= 0.25), F.lit(1)),
            ("overall_low_quality", (t >= 5) & (F.col("usable_rate") < 0.7), F.lit(1)),
        ],
    )


def merge_stats(existing: DataFrame, inventory: DataFrame, frequency: str = "daily") -> DataFrame:
    """Stored statistics brought up to date with the inventory, keyed by (date, source).

    Counts come from the inventory. Historical rows that it does not hold any more vanish, other rows fall to zero. A
    zero or failed day that has articles now is ``recovered``. Days that are new are ``historical``.
    """
    e, i = existing.alias("e"), inventory.select("date", "source", "article_count", "usable_articles").alias("i")
    both = e.join(i, ["date", "source"], "full_outer")
    n = F.coalesce("i.article_count", F.lit(0).cast("long"))
    status = F.when(F.col("e.crawl_status").isNull(), "historical").when(F.col("e.crawl_status").isin("zero", "failed") & (n > 0), "recovered").otherwise(F.col("e.crawl_status"))
    gone = (F.col("e.crawl_status") == "historical") & F.col("i.article_count").isNull()
    both = both.where(~F.coalesce(gone, F.lit(False)))
    return both.select("date", "source", F.coalesce("e.frequency", F.lit(frequency)).alias("frequency"), status.alias("crawl_status"), n.alias("article_count"), F.coalesce("i.usable_articles", F.lit(0).cast("long")).alias("usable_articles"))


def merge_health(stats: DataFrame, health: DataFrame, inventory: DataFrame, day: Column) -> DataFrame:
    """Statistics in which a run's health rows replace the day's: counts from the inventory, zero if it has none.

    A channel that reports zero but has articles stored is ``already_collected``.
    """
    found = health.select("source", "frequency", "status", day.alias("date")).join(inventory.select("date", "source", "article_count", "usable_articles"), ["date", "source"], "left")
    n = F.coalesce("article_count", F.lit(0).cast("long"))
    fresh = found.select("date", "source", "frequency", F.when((F.col("status") == "zero") & (n > 0), "already_collected").otherwise(F.col("status")).alias("crawl_status"), n.alias("article_count"), F.coalesce("usable_articles", F.lit(0).cast("long")).alias("usable_articles"))
    return stats.join(fresh.select("date", "source"), ["date", "source"], "left_anti").unionByName(fresh)


def crawl_status(changed: Column, usable: Column, expected: Column) -> Column:
    """idle, zero, degraded or healthy."""
    return F.when((changed == 0) & ~expected, "idle").when(changed == 0, "zero").when(F.greatest(changed - usable, F.lit(0)) > 0, "degraded").otherwise("healthy")


def missing_runs(stats: DataFrame, summary: DataFrame, inventory: DataFrame, lookback: int = 31, latest: Column | None = None) -> DataFrame:
    """Days on which a channel should have been crawled and no run was recorded: ``date, source, frequency``.

    Days between the first audited one (31 days back at most) and the last that no audit covers, for channels that
    were active by then, are not skipped now, are expected on that day and have no articles of it. With ``latest`` as
    the last day there are no gaps at all unless that day is audited itself: an audit that has not run finds nothing.
    """
    audited = summary.where("sources_configured > 0").select("date").distinct() if latest is None else audited_days(summary, latest)
    ends = audited.agg(F.min("date").alias("first"), F.max("date").alias("last")).where("first < last")
    days = ends.select(F.explode(F.sequence(F.greatest("first", F.date_sub("last", lookback)), F.date_sub("last", 1))).alias("date"))
    days = days.join(audited, "date", "left_anti")
    profile = stats.groupBy("source").agg(
        F.min(F.when(F.col("crawl_status") != "historical", F.col("date"))).alias("active_from"),
        F.max_by(F.struct("frequency", "crawl_status"), F.col("date")).alias("now"),
    )
    profile = profile.where("active_from IS NOT NULL AND now.crawl_status <> 'skipped'").select("source", "active_from", F.col("now.frequency").alias("frequency"))
    cells = profile.join(F.broadcast(days), F.col("date") >= F.col("active_from")).where(expects_on(F.col("frequency"), F.col("date")))  # days: at most the look-back
    have = inventory.where("article_count > 0").select("date", "source")
    return cells.join(have, ["date", "source"], "left_anti").select("date", "source", "frequency")
