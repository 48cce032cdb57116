"""The command line over a home of stored tables, and messages by an injected webhook."""

import datetime as dt
import json
import zipfile

import pytest

from newsloom import cli
from newsloom.plans import cycle
from newsloom.sources import edges, workbooks

ARTICLE = "published_at string, url string, source_name string, content_status string, content string"


def health(path, day, rows):
    told = [{"source": s, "frequency": "每日", "status": status, "reason": reason, "crawl_mode": "rss", "error_type": "", "candidates_seen": 1, "pages_fetched": 1} for s, status, reason in rows]
    path.write_text(json.dumps({"generated_at": f"{day}T07", "target_date": day, "sources": told}), encoding="utf-8")
    return str(path)


def test_days_from_the_command_line(spark, tmp_path, monkeypatch, capsys):
    home, table = str(tmp_path / "home"), str(tmp_path / "articles")

    def add(day, source):
        spark.createDataFrame([(day, f"https://{source}/{day}", source, "full", "x" * 600)], ARTICLE).coalesce(1).write.mode("append").parquet(table)

    add("2024-01-01", "a")
    told = health(tmp_path / "h.json", "2024-01-01", [("a", "healthy", ""), ("b", "failed", "HTTP 503; password=x")])
    monkeypatch.delenv(cli.WEBHOOK, raising=False)
    assert cli.main(["cycle", "--home", home, "--articles", table, "--health", told]) == 0 and "no messages" in capsys.readouterr().out
    posted = []
    monkeypatch.setenv(cli.WEBHOOK, "https://oapi.dingtalk.com/robot/send?access_token=t")
    monkeypatch.setenv(cli.SECRET, "s")
    send = lambda url, body: posted.append((url, json.loads(body))) or '{"errcode": 0}'
    assert cli.main(["notify", "--home", home], send=send) == 0
    assert "&timestamp=" in posted[0][0] and "&sign=" in posted[0][0] and "### 待人工确认｜b" in posted[0][1]["markdown"]["text"] and "password=x" not in str(posted)
    assert cli.main(["notify", "--home", home], send=send) == 0 and len(posted) == 1
    capsys.readouterr()
    assert cli.main(["check", "--home", home]) == 1 and "2024-01-01 b: 站点服务暂时不可用" in capsys.readouterr().out
    assert cli.main(["resolve", "--home", home, "confirm", "--source", "b", "--date", "2024-01-01", "--note", "mended"]) == 0
    assert cli.main(["resolve", "--home", home, "confirm", "--source", "b", "--date", "2024-01-02"]) == 1
    asked = []

    def run(command):
        asked.append(command)
        add(command[-2], command[-1])
        return 0

    assert cli.main(["recover", "--home", home, "--articles", table, "--command", "fill --all 'x y'"], run=run) == 0
    assert asked == [["fill", "--all", "x y", "2024-01-01", "b"]] and cli.main(["check", "--home", home]) == 0
    got = cycle.current(spark, home, "queue", cycle.QUEUE).first()
    assert (got["status"], got["attempts"], got["confirmation_note"], got["recovered_articles"]) == ("recovered", 1, "mended", 1)
    assert cli.main(["status", "--home", home, "--report", str(tmp_path / "r")]) == 0
    report = json.loads((tmp_path / "r" / "channel-ops-report.json").read_text(encoding="utf-8"))
    assert report["summary"]["channels"] == 2 and (tmp_path / "r" / "channel-ops-report.md").read_text(encoding="utf-8").startswith("# 渠道运维总览")


def test_exports(spark, tmp_path):
    rows = [(f"T{k % 3}", f"2024-01-{5 + k:02}", "text", f"https://h.org/{k % 3}", f"s{k}", "d", "") for k in range(4)] + [("U", "2024-02-01", "text", "https://h.org/u", "s", "d", "")]
    table = str(tmp_path / "t")
    spark.createDataFrame(rows, "title string, published_at string, content string, url string, source_name string, domain string, sub_domain string").write.parquet(table)
    span = ["--start", "2024-01-01", "--end", "2024-01-31"]
    assert cli.main(["weekly", "--articles", table, "--out", str(tmp_path / "w"), *span]) == 0
    exported = spark.read.option("header", True).csv(str(tmp_path / "w" / "articles_week_2024-W05.csv"))
    assert sorted((r["title"], r["published_at"]) for r in exported.collect()) == [("T0", "2024-01-05"), ("T1", "2024-01-06"), ("T2", "2024-01-07")]
    assert cli.main(["monthly", "--articles", table, "--out", str(tmp_path / "m"), *span]) == 0
    assert len(list(workbooks.rows((tmp_path / "m" / "articles_month_2024-01.xlsx").read_bytes()))) == 4
    assert cli.main(["rollup", "month", "--articles", table, "--out", str(tmp_path / "r"), *span]) == 0
    with pytest.raises(SystemExit):
        cli.main(["weekly", "--articles", table, "--out", "x", "--start", "2024-01-01"])
    spark.createDataFrame([("https://a", "Verify you are human. Cloudflare"), ("https://b", "a text")], "url string, content string").write.json(str(tmp_path / "in.jsonl"))
    assert cli.main(["purge", "--articles", str(tmp_path / "in.jsonl"), "--out", str(tmp_path / "out")]) == 0
    assert [r["url"] for r in spark.read.json(str(tmp_path / "out")).collect()] == ["https://b"]
    with zipfile.ZipFile(tmp_path / "map.xmind", "w") as z:
        z.writestr("content.json", json.dumps([{"rootTopic": {"title": "R", "children": {"attached": [{"title": "a"}]}}}]))
    (tmp_path / "t.json").write_text(json.dumps({"categories": [{"path": ["R", "b"]}]}))
    assert cli.main(["taxonomy", str(tmp_path / "map.xmind"), "--taxonomy", str(tmp_path / "t.json")]) == 1


def test_webhooks():
    for bad in ("http://oapi.dingtalk.com/x", "https://dingtalk.com.evil.org/x", "https://evildingtalk.com/", "ftp://dingtalk.com", "", "https://x@evil.org/dingtalk.com"):
        with pytest.raises(ValueError, match="webhook has to be"):
            edges.signed_url(bad, "", 0)
    # HMAC-SHA256 of "1700000000000\nsecret" under "secret"
    import base64
    import hashlib
    import hmac
    from urllib.parse import parse_qs, urlsplit

    url = edges.signed_url("https://oapi.dingtalk.com/robot", "secret", 1_700_000_000_000)
    query = parse_qs(urlsplit(url).query)
    assert query["timestamp"] == ["1700000000000"] and base64.b64decode(query["sign"][0]) == hmac.new(b"secret", b"1700000000000\nsecret", hashlib.sha256).digest()
    assert edges.signed_url("https://dingtalk.com/x?a=1", "", 0) == "https://dingtalk.com/x?a=1"
    waits, tries = [], []

    def post(url, body):
        tries.append(url)
        if len(tries) < 3:
            raise OSError("no route")
        return '{"errcode": 0}'

    sender = edges.webhook_sender("https://dingtalk.com/x", "", post, lambda: 1.0, sleep=waits.append)
    assert sender("text") and waits == [1.0, 2.0]
    for answer, said in (("<html>", "no JSON"), ('{"errcode": 310000, "errmsg": "sign; secret=abc"}', "REDACTED")):
        with pytest.raises(edges.NotificationError, match=said):
            edges.webhook_sender("https://dingtalk.com/x", "", lambda u, b, a=answer: a, lambda: 1.0)("text")  # noqa: B023

    def dead(url, body):
        raise OSError("no route")

    with pytest.raises(edges.NotificationError, match="no connection"):
        edges.webhook_sender("https://dingtalk.com/x", "", dead, lambda: 1.0)("text")


def test_alerts():
    rows = [{"id": str(k), "date": dt.date(2024, 1, 5), "source": f"s{k}", "status": "recovery_failed", "last_error": "a\nb; api_key=z", "technical_reason": "HTTP 500", "failed_at": "", "detected_at": "t", "diagnosis_code": "timeout"} for k in range(2)]
    text = edges.alert(rows, 5, run_url="https://h.org/run", cap=2)
    assert text.count("### 补抓失败｜") == 2 and "- 诊断：a b; api_key=[REDACTED]" in text and "- 原始错误：HTTP 500" in text and "- 错误类型：`timeout`" in text and "另有 3 条" in text and "(https://h.org/run)" in text
