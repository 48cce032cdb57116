"""Readers of state, health and exports, credentials of feeds, and which host wants a browser."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, urls
from newsloom.sources import feeds, files, scratch


def test_health_reports(spark, tmp_path):
    told = {"generated_at": "g", "target_date": "2024-01-05", "sources": [{"source": "a", "status": "healthy", "candidates_seen": 3}, {"source": "", "status": "x"}, {"source": "b"}]}
    (tmp_path / "h.json").write_text(json.dumps(told, indent=1))
    rows = files.health_rows(files.read_state(spark, str(tmp_path / "h.json"), files.HEALTH)).orderBy("source").collect()
    assert [(r["source"], r["status"], r["candidates_seen"], r["pages_fetched"], r["target_date"]) for r in rows] == [("a", "healthy", 3, 0, "2024-01-05"), ("b", "", 0, 0, "2024-01-05")]
    (tmp_path / "bad.json").write_text('{"sources": [')
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        files.read_state(spark, str(tmp_path / "bad.json"), files.HEALTH).collect()


def test_exports_of_a_medium(spark, tmp_path):
    head = ["新闻标题", "发布时间", "发布媒体", "链接", "新闻全文"]
    garbled = [h.encode("gbk").decode("latin-1") for h in head]
    rows = [["T1", "2024-01-05 10:00", "电池网_a", "u1", "first"], ["T2", "2024-01-05", "电池网_b", "u1", "again"], ["", "2024-01-05", "电池网_b", "u2", ""], ["T3", "2024-01-06", "电池网_b", "u3", ""], ["T4", "2024-01-05", "其他_b", "u4", ""]]
    (tmp_path / "a.xlsx").write_bytes(files.write_workbook({"S": (garbled, rows)}))
    got = files.read_export(spark, str(tmp_path / "a.xlsx"), "电池网_", F.lit("2024-01-05").cast("date"), dates.published_date).collect()
    assert [(r["url"], r["title"], r["content"]) for r in got] == [("u1", "T1", "first")]
    (tmp_path / "b.xlsx").write_bytes(files.write_workbook({"S": (head[:3], [])}))
    with pytest.raises(Exception, match="has no column for"):
        files.read_export(spark, str(tmp_path / "b.xlsx"), "", F.lit("2024-01-05").cast("date"), dates.published_date).collect()


def test_first_paths_and_days(spark, tmp_path):
    (tmp_path / "b").mkdir()
    assert files.first_path(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).endswith("b")
    with pytest.raises(FileNotFoundError):
        files.first_path(spark, [str(tmp_path / "a")])
    days = [r[0] for r in spark.range(1).select(F.explode(F.array(*(F.lit(p) for p in ("/x/2020-01-01/articles-2024-01-05.csv/part-0.csv", "articles-2024-01-06.csv", "/none")))).alias("p")).select(files.file_date(F.col("p"))).collect()]
    assert days == [dt.date(2024, 1, 5), dt.date(2024, 1, 6), None]
    assert [r["date"].day for r in dates.spine(spark, F.lit(dt.date(2024, 1, 30)), F.lit(dt.date(2024, 2, 1))).orderBy("date").collect()] == [30, 31, 1]
    assert scratch.fresh(spark, "x") != scratch.fresh(spark, "x")
    files.write_text(spark, str(tmp_path / "t.txt"), "é")
    files.write_text(spark, str(tmp_path / "t.txt"), "é2")
    assert (tmp_path / "t.txt").read_text(encoding="utf-8") == "é2"


def test_credentials_of_feeds():
    secrets = ("FEED_USER", "FEED_KEY")
    assert feeds.feed_access("Renewables Now", "u", "renewables now", secrets, {"FEED_USER": "me", "FEED_KEY": "k"}) == ("u", ("me", "k"))
    assert feeds.feed_access("other", "u", "renewables now", secrets, {"FEED_USER": "me", "FEED_KEY": "k"}) == ("u", None)
    assert feeds.feed_access("renewables now", "u", "renewables now", secrets, {}) == ("u", None)
    with pytest.raises(ValueError, match="together"):
        feeds.feed_access("renewables now", "u", "renewables now", secrets, {"FEED_KEY": "k"})


def test_hosts_that_want_a_browser(spark):
    rows = spark.createDataFrame([("https://news.sciencenet.cn/x",), ("https://insideevs.com/",), ("https://notinsideevs.com/",), ("",), (None,)], "u string")
    assert [r[0] for r in rows.select(urls.wants_browser_agent(F.col("u"))).collect()] == [True, True, False, False, False]
