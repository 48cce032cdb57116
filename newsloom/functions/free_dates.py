"""Dates in free text: a reader of tokens for what no list of formats holds.

A text is cut into tokens of kinds (number, month, weekday, time, zone, separators); every number may be a day, a month or
a year, and the reading is taken that uses the most of the tokens that stand together and breaks no rule of a calendar.
Nothing is filled in: a text without a day, a month and a year has no date.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from newsloom.functions.dates import ZONE

#: Names of months by their first letters, weekdays, zones in hours, and how Chinese dates are written.
MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
FULL_MONTHS = "january february march april may june july august september october november december".split()
WEEKDAYS = {"mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "sun", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"}
ZONES = {"utc": 0, "gmt": 0, "z": 0, "est": -5, "edt": -4, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
CHINESE = str.maketrans({"年": "-", "月": "-", "日": " ", "时": ":", "分": ":", "秒": " ", "：": ":", "，": ",", "　": " "})
_TOKEN = re.compile(
    r"(?P<time>(?<!\d)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?:?(?!\d))|(?P<iso>(?<=\d)T(?=\d))|(?P<offset>(?<=[\d\s])[+-]\d{2}:?\d{2}(?!\d))|(?P<number>\d+)|(?P<word>[A-Za-z]+\.?)|(?P<mark>[-/.,])|(?P<blank>\s+)|(?P<other>.)",
    re.S,
)
#: Year around which two digits are read: the century that lies nearest, the past at a tie.
PIVOT = 2024


def month_of(word: str) -> int | None:
    """A month by its name, its first three letters or ``sept``."""
    word = word.lower().rstrip(".")
    if word == "sept":
        return 9
    return MONTHS.get(word[:3]) if len(word) == 3 or word in FULL_MONTHS else None


def year_of(digits: str, pivot: int = PIVOT) -> int | None:
    """A year of four digits, or of two in the century around the pivot."""
    if len(digits) == 4:
        return int(digits) or None
    if len(digits) != 2:
        return None
    year = pivot // 100 * 100 + int(digits)
    return year - 100 if year >= pivot + 50 else year + 100 if year < pivot - 50 else year


def _kinds(text: str) -> list[tuple[str, str]]:
    """Tokens with their kinds; what looks like an offset is one only behind a time."""
    out: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        found = _TOKEN.match(text, at)
        kind, token = found.lastgroup, found[0]
        if kind == "offset" and next((k for k, _ in reversed(out) if k != "blank"), "") != "time":
            kind, token = "mark", token[0]
        out.append((kind, token))
        at += len(token)
    return out


def _readings(parts: list[tuple[str, str]], day_first: bool) -> Iterator[tuple[int, tuple[int, int, int]]]:
    """Dates that three parts (numbers and months in words) may be, the usual order of such parts first."""
    words = [i for i, (kind, _) in enumerate(parts) if kind == "month"]
    if len(words) > 1:
        return
    digits = [p for k, p in parts if k != "month"]
    if any(len(d) not in (1, 2, 4) for d in digits):
        return
    long = [i for i, (k, p) in enumerate(parts) if k != "month" and len(p) == 4]
    if len(long) > 1:
        return
    if long == [0] or not long and not words and len(parts[0][1]) == 2 and int(parts[0][1]) > 31:
        usual = "ymd"
    elif words == [1]:
        usual = "dmy"
    elif words == [0] or not day_first:
        usual = "mdy"
    else:
        usual = "dmy"
    orders = sorted({"".join(o) for o in permutations("ymd")}, key=lambda o: (o != usual, o not in ("ymd", "dmy", "mdy"), o))
    for cost, order in enumerate(orders):
        at = {c: i for i, c in enumerate(order)}
        if words and at["m"] != words[0] or long and at["y"] != long[0]:
            continue
        year = year_of(parts[at["y"]][1])
        month = month_of(parts[at["m"]][1]) if words else int(parts[at["m"]][1])
        day = int(parts[at["d"]][1])
        if len(parts[at["y"]][1]) == 1 or year is None or not 1 <= month <= 12:
            continue
        try:
            dt.date(year, month, day)
        except ValueError:
            continue
        yield cost, (year, month, day)


def _date(tokens: list[tuple[str, str]], day_first: bool) -> tuple[tuple[int, int, int], int] | None:
    """The first date in a row of tokens and where it ends."""
    best = None
    for start, (kind, text) in enumerate(tokens):
        if kind == "number" and len(text) in (8, 12, 14):  # 20240105, and with a time behind it
            try:
                day = dt.datetime.strptime(text[:8], "%Y%m%d").date()
            except ValueError:
                day = None
            if day and 1900 <= day.year <= 2100:
                return (day.year, day.month, day.day), start + 1
        if not (kind == "number" or kind == "word" and month_of(text)):
            continue
        parts, at, gap = [], start, 0
        while at < len(tokens) and len(parts) < 3 and gap <= 3:
            k, t = tokens[at]
            if k == "number":
                parts.append(("number", t))
                gap = 0
            elif k == "word" and month_of(t):
                parts.append(("month", t))
                gap = 0
            elif k == "blank":
                pass
            elif k == "mark" or k == "word" and t.lower().rstrip(".") in {"st", "nd", "rd", "th", "of", *WEEKDAYS}:
                gap += 1
            elif k == "time" and len(parts) == 2:  # Jan 5 10:30:00 2024
                gap = 0
            else:
                break
            at += 1
        if len(parts) == 3:
            for cost, day in _readings(parts, day_first):
                if best is None or cost < best[0]:
                    best = (cost, day, at)
                break
            if best and best[0] == 0:
                break
    return (best[1], best[2]) if best else None


@lru_cache(maxsize=100_000)
def read(text: str | None, day_first: bool = False, zone: str = ZONE) -> str | None:
    """The local date of a text as yyyy-mm-dd; None if it has none.

    A time with an offset or the name of a zone is moved to the local zone; without either, day and time are local. Of
    numbers alone a year of four digits decides their order, else month, day and year follow each other (day first, if
    asked for), unless the calendar allows that only otherwise.
    """
    tokens = _kinds((text or "").translate(CHINESE).strip()[:400])
    found = _date(tokens, day_first)
    if not found:
        return None
    (year, month, day), _ = found
    moment = dt.datetime(year, month, day)
    clock = next((i for i, (k, _) in enumerate(tokens) if k == "time"), None)
    if clock is None:
        return moment.date().isoformat()
    hours, minutes, *seconds = re.split("[:.,]", tokens[clock][1].rstrip(":"))
    hour = int(hours)
    after = [(k, t.lower().rstrip(".")) for k, t in tokens[clock + 1 : clock + 7] if k != "blank"]
    half = next((t for k, t in after[:1] if k == "word" and t in ("am", "pm", "a", "p")), "")
    if half and 1 <= hour <= 12:
        hour = hour % 12 + (12 if half.startswith("p") else 0)
    if hour > 23 or int(minutes) > 59:
        return moment.date().isoformat()
    moment = moment.replace(hour=hour, minute=int(minutes), second=min(59, int(seconds[0])) if seconds else 0)
    for kind, word in after:
        if kind == "offset":
            sign = -1 if word[0] == "-" else 1
            moment -= sign * dt.timedelta(hours=int(word[1:3]), minutes=int(word[-2:]))
            break
        if kind == "word" and word in ZONES:
            moment -= dt.timedelta(hours=ZONES[word])
            break
    else:
        return moment.date().isoformat()
    return moment.replace(tzinfo=dt.UTC).astimezone(ZoneInfo(zone)).date().isoformat()


@F.pandas_udf(StringType())
def _read(texts: pd.Series, day_first: pd.Series) -> pd.Series:
    return pd.Series([read(t, bool(d)) for t, d in zip(texts, day_first, strict=True)], dtype=object)


def free_date(text: Column, day_first: Column | None = None) -> Column:
    """``read`` for a column, in Arrow batches; equal texts of a worker are read once."""
    return _read(text, F.lit(False) if day_first is None else day_first).cast("date")
