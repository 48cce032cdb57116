"""Date functions: dates in addresses and texts, target dates, periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
#: How addresses spell dates, the first that is found decides; zones that texts name.
URL_DATES = [r"t(20\d{2})(\d{2})(\d{2})_", r"/(20\d{2})(\d{2})(\d{2})/", r"/(20\d{2})(\d{2})/(\d{2})/", r"/(20\d{2})(\d{2})/(\d{1,2})[^/]*\.html", r"(20\d{2})[-_/](\d{1,2})[-_/](\d{1,2})"]
ZONE_HOURS = {"EST": "-05:00", "EDT": "-04:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00", "GMT": "+00:00", "UTC": "+00:00", "Z": "+00:00"}
#: Formats that are read, the first that fits decides. With an offset in the text, then without.
WITH_OFFSET = ["yyyy-M-d'T'H:mm:ssXXX", "yyyy-M-d'T'H:mm:ss.SSSXXX", "yyyy-M-d H:mm:ss XXX", "yyyy-M-d H:mm:ssXXX", "d MMM yyyy H:mm:ss XXX", "MMM d, yyyy H:mm XXX"]
LOCAL = ["yyyy-M-d'T'H:mm:ss", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d", "M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyyMMdd"]


def url_date(url: Column) -> Column:
    """The date in an address; null without one, and if the first spelling that is found is no date."""
    url, out = F.coalesce(url, F.lit("")), F.lit(None).cast("date")
    for pattern in reversed(URL_DATES):
        y, m, d = (F.regexp_extract(url, pattern, i) for i in (1, 2, 3))
        out = F.when(y != "", _date(y, m, d)).otherwise(out)
    return out


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def published_date(text: Column, day_first: Column | None = None) -> Column:
    """The local (Asia/Shanghai) date of a publication time in one of the known formats; null for any other text.

    Times with an offset or a zone name are converted, others are local already. ``day_first`` reads d/m/yyyy.
    """
    value = F.regexp_replace(F.translate(F.trim(F.coalesce(text, F.lit(""))), "年月日秒时分", "--  ::"), r"\s+", " ")
    value = F.trim(F.regexp_replace(value, r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+", ""))
    to = lambda c, f: F.try_to_timestamp(c, F.lit(f))

    def zoned(v: Column) -> Column:
        out = F.regexp_replace(F.regexp_replace(v, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"(?<=\d)Z$", "+00:00")
        name = F.regexp_extract(out, r"\s([A-Z]{1,3})$", 1)
        hours = F.element_at(F.create_map(*(F.lit(x) for kv in ZONE_HOURS.items() for x in kv)), name)
        return F.when(hours.isNotNull(), F.concat(F.regexp_replace(out, r"\s+[A-Z]{1,3}$", " "), hours)).otherwise(out)

    # Instants are moved from the session's zone to the local one; local times are read as they stand.
    def moved(v: Column) -> Column:
        instant = F.coalesce(*(to(v, f) for f in WITH_OFFSET))
        return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(ZONE), instant.cast("timestamp_ntz")))

    def read(v: Column) -> Column:
        has_offset = v.rlike(r"(?:[+-]\d{2}:?\d{2}|Z|\s[A-Z]{1,3})$") & v.rlike(r"\d:\d")
        return F.when(has_offset, once(zoned(v), moved)).otherwise(F.to_date(F.coalesce(*(to(v, f) for f in LOCAL))))

    def dated(v: Column) -> Column:
        if day_first is None:
            return read(v)
        parts = [F.regexp_extract(v, r"^(\d{1,2})/(\d{1,2})/(20\d{2})\b", i) for i in (1, 2, 3)]
        return F.when(day_first & (parts[0] != ""), _date(parts[2], parts[1], parts[0])).otherwise(read(v))

    return once(value, lambda v: F.when(v != "", dated(v)))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def article_date(published_at: Column, url: Column) -> Column:
    """The date of publication, else the date in the address."""
    return F.coalesce(published_date(published_at), url_date(url))


def target_date(ts: Column, rollover_hour: int = 6) -> Column:
    """The day that a run at a local time collects: the day before its nominal day, which begins at the rollover hour."""
    return F.date_sub(F.to_date(ts - F.expr(f"INTERVAL {rollover_hour} HOURS")), 1)


def default_target_date(now: dt.datetime, rollover_hour: int = 6, zone: str = ZONE) -> dt.date:
    """``target_date`` of one moment; one without a zone is local."""
    if not 0 <= rollover_hour <= 23:
        raise ValueError("rollover_hour has to be from 0 to 23")
    local = now.replace(tzinfo=ZoneInfo(zone)) if now.tzinfo is None else now.astimezone(ZoneInfo(zone))
    return local.date() - dt.timedelta(days=1 + (local.hour < rollover_hour))


def parse_target_date(value: str | None, now: dt.datetime, rollover_hour: int = 6) -> dt.date:
    """A date as yyyy-mm-dd, strictly; without one the default."""
    return dt.datetime.strptime(value, "%Y-%m-%d").date() if value else default_target_date(now, rollover_hour)


def week_label(day: Column) -> Column:
    """``2024-W05`` by ISO weeks."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def period(day: Column, unit: str) -> tuple[Column, Column]:
    """First and last day of the ISO week or the month of a day."""
    first = F.trunc(day, unit)
    return first, F.date_add(first, 6) if unit == "week" else F.last_day(day)


def previous_period(today: dt.date, unit: str) -> tuple[dt.date, dt.date]:
    """First and last day of the week or month before the one of a day."""
    if unit == "week":
        first = today - dt.timedelta(days=today.weekday() + 7)
        return first, first + dt.timedelta(days=6)
    last = today.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=1), last


def spine(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """All days from first to last: ``date``."""
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("date"))
