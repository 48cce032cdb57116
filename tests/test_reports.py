"""Run statistics, reports, page bodies and stored exports."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import incidents, reports
from newsloom.sources import files


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_trim_body(spark):
    page = "First line of the body.\nshort\nSource: somebody else\nmail me at a.b@c.de today\nwww.example.org/page\n2024-01-02 10:30\nSecond line\tof  the body.\nRelated Articles\nA line that comes after."
    assert value(spark, text.trim_body(F.lit(page))) == "First line of the body.\nSecond line of the body."
    assert value(spark, text.trim_body(F.lit("\nShare\nA body that begins late."))) == "A body that begins late."
    assert value(spark, text.trim_body(F.lit("A body of one line.\n如需转载请联系我们谢谢\nNever reached by anyone."))) == "A body of one line."
    assert value(spark, text.trim_body(F.lit(None).cast("string"))) == "" and value(spark, text.trim_body(F.lit(""))) == ""


@pytest.mark.parametrize(
    ("title", "content", "source", "expected"),
    [("NE时代", "ne时代\n\n  The real one \nmore", " NE时代 ", "The real one"), ("Own", "x", "NE时代", "Own"), ("", "y" * 600, "ne时代", "y" * 500), ("ne时代", "", "ne时代", "ne时代"), ("NE时代", "x", "other", "NE时代")],
)
def test_repaired_title(spark, title, content, source, expected):
    assert value(spark, text.repaired_title(F.lit(title), F.lit(content), F.lit(source))) == expected


def test_strip_takes_every_blank(spark):
    assert value(spark, text.strip(F.lit(" \t　 x  y \x85"))) == "x  y"


def test_only_sources(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "name string")
    assert reports.only_sources(rows, ["b"]).count() == 1
    with pytest.raises(reports.UnknownSources, match="c") as caught:
        reports.only_sources(rows, ["a", "c"])
    assert caught.value.exit_code == 2


def test_remember_keeps_the_last(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, at long")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "id string, at long")
    assert [r["id"] for r in reports.remember(old, new, [F.col("at")], 2).collect()] == ["c", "b"]


def test_reports_render(spark):
    state = spark.createDataFrame([("a", "healthy", "", 0, 0, "none"), ("b|c", "failed", "healthy", 2, 1, "repair_then_confirm")], "source string, last_status string, previous_status string, consecutive_unhealthy long, open_incidents long, next_action string")
    queue = spark.createDataFrame([("2024-01-05::b|c", dt.date(2024, 1, 5), "b|c", "pending_confirmation", 0, 0, "timeout", "x")], "id string, date date, source string, status string, attempts long, recovered_articles long, diagnosis_code string, updated_at string")
    report = reports.operations_report(state, queue, "now")
    assert report["summary"]["status_counts"] == {"failed": 1, "healthy": 1} and [c["source"] for c in report["channels"]] == ["b|c", "a"]
    assert json.loads(reports.as_json(report))["incidents"][0]["date"] == "2024-01-05"
    page = reports.operations_markdown(report)
    assert "| b\\|c | failed | 2 | 1 | repair_then_confirm |" in page and "- 异常渠道：1" in page
    day = dt.date(2024, 1, 5)
    judged = spark.createDataFrame([(day, "a", "normal", 3, ""), (day, "b", "warning", 0, "no_output"), (day, "a2", "critical", 0, "fetch_failed")], "date date, source string, anomaly_level string, article_count long, anomaly_codes string")
    summary = spark.createDataFrame([(day, 3, 3, "warning")], "date date, total_articles long, usable_articles long, anomaly_level string")
    audit = reports.audit_report(judged, summary, queue, day)
    assert [c["source"] for c in audit["channels"]] == ["a2", "b"]
    assert "| critical | a2 | 0 | - | - | - | fetch_failed |" in reports.audit_markdown(audit)
    assert "| normal | - |" in reports.audit_markdown(reports.audit_report(judged, summary, queue, dt.date(2024, 1, 6)))


def test_health_report_and_week(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "source string, n long")
    report = json.loads(reports.health_report(rows, F.lit("2024-01-05"), F.lit("t"), ["source", "n"]).first()["report"])
    assert [s["source"] for s in report["sources"]] == ["a", "b"] and report["target_date"] == "2024-01-05"
    assert reports.week_name(dt.date(2024, 12, 30)) == "articles_week_2025-W01.csv"


def test_first_source_with_rows(spark):
    empty, some = spark.range(0), spark.range(2)
    assert reports.first_that_has_rows([lambda: empty, lambda: some]).count() == 2 and reports.first_that_has_rows([lambda: empty]) is None


def test_window_of_exports(spark, tmp_path):
    rows = spark.createDataFrame([("t", dt.date(2024, 1, 3))], "title string, day date")
    files.export_day(rows, str(tmp_path), dt.date(2024, 1, 3), ["title"], F.col("day"))
    got = files.read_window(spark, str(tmp_path), dt.date(2024, 1, 1), dt.date(2024, 1, 5), ["title"]).collect()
    assert [r["title"] for r in got] == ["t"]
    assert files.read_window(spark, str(tmp_path), dt.date(2023, 1, 1), dt.date(2023, 1, 5), ["title"]).count() == 0
    assert files.first_path(spark, [str(tmp_path / "no"), str(tmp_path)]) == str(tmp_path)
    with pytest.raises(FileNotFoundError):
        files.first_path(spark, [str(tmp_path / "no")])


def test_resolve_by_frame(spark):
    queue = spark.createDataFrame([("a", "pending_confirmation", "x"), ("b", "recovered", "x")], "id string, status string, updated_at string")
    after = incidents.resolve(queue, queue.select("id"), "confirm", F.lit("now")).orderBy("id").collect()
    assert [(r["status"], r["updated_at"]) for r in after] == [("confirmed", "now"), ("recovered", "x")]
