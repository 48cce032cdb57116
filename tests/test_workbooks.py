"""Workbooks in bounded memory, their round trip and their split by day, and mind maps against a taxonomy."""

import datetime as dt
import io
import json
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from newsloom.operators import reports, taxonomy
from newsloom.sources import files, workbooks
from newsloom.sources.workbooks import Book

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def foreign(sheet, shared="", styles="", book="<workbookPr/>"):
    """A workbook as other programs write it: shared texts, styles, and the sheet to open being the second."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS}>{book}<bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="no" sheetId="1" r:id="a"/><sheet name="yes" sheetId="2" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/one.xml"/><Relationship Id="b" Target="/xl/worksheets/two.xml"/></Relationships>')
        z.writestr("xl/worksheets/two.xml", f"<worksheet {NS}><sheetData>{sheet}</sheetData></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{shared}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {NS}>{styles}</styleSheet>")
    return out.getvalue()


def test_cells_of_every_kind():
    styles = '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    shared = "<si><t>one</t></si><si><r><t>two </t></r><r><t>parts</t></r></si><si/>"
    sheet = '<row><c r="B1" t="s"><v>1</v></c><c t="s"><v>0</v></c><c r="AA1"><v>7</v></c></row><row/><row><c s="1"><v>45296</v></c><c s="2"><v>45296.5</v></c><c s="3"><v>45296</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="inlineStr"><is><t>x</t></is></c><c t="str"><v>f</v></c><c s="1"><v>1</v></c><c t="s"><v>2</v></c></row>'
    got = list(workbooks.rows(foreign(sheet, shared, styles)))
    assert got == [["", "two parts", "one", *[""] * 23, "7"], [], ["2024-01-05", "2024-01-05 12:00:00", "45296", "TRUE", "", "x", "f", "1900-01-01", ""]]
    early = list(workbooks.rows(foreign('<row><c s="1"><v>0</v></c></row>', "", styles, '<workbookPr date1904="1"/>')))
    assert early == [["1904-01-01"]]


def test_round_trip_with_links_and_many_rows(monkeypatch):
    out = io.BytesIO()
    book = Book(out)
    content = [["a\x01<b>&\"c", 1.5, None, "https://h.org/?a=1&b=\"2\""], ["é", -3, "x" * 40_000, "none"], ["", 0, float("nan"), "https://h.org/x\ny"]]
    assert book.sheet("All & more", ["t", "n", "long", "url"], content) == 3
    book.close()
    got = list(workbooks.rows(out.getvalue()))
    assert got[0] == ["t", "n", "long", "url"] and got[1] == ['a<b>&"c', "1.5", "", 'https://h.org/?a=1&b="2"'] and got[2][:2] == ["é", "-3"] and len(got[2][2]) == 32_767
    with zipfile.ZipFile(out) as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
        assert 'state="frozen"' in sheet and 'autoFilter ref="A1:D4"' in sheet and 'max="3" width="60"' in sheet and 'max="2" width="10"' in sheet
        assert z.read("xl/worksheets/_rels/sheet1.xml.rels").decode().count("TargetMode") == 2
    monkeypatch.setattr(workbooks, "MOST_ROWS", 4)
    out = io.BytesIO()
    book = Book(out)
    assert book.sheet("S", ["k"], ([k] for k in range(8))) == 8
    book.close()
    assert book.names == ["S", "S 2", "S 3"]


def test_a_long_sheet_takes_little_memory(tmp_path):
    path = tmp_path / "long.xlsx"
    with path.open("wb") as target:
        book = Book(target)
        n = 120_000
        assert book.sheet("Long", ["k", "url", "text"], ([k, "no link", "some text"] for k in range(n))) == n
        book.close()
    tracemalloc.start()
    with path.open("rb") as source:
        count = sum(1 for _ in workbooks.rows(source))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == n + 1 and peak < 8_000_000  # the sheet itself has over 20 MB


def test_five_sheets_of_a_month(spark, tmp_path):
    rows = [(f"T{k}", "2024-01-05", "text", f"https://h.org/{k}", f"s{k % 2}", "d", "", dt.date(2024, 1, 5 + k % 2), "c", "") for k in range(7)]
    frame = spark.createDataFrame(rows, "title string, published_at string, content string, url string, source_name string, domain string, sub_domain string, summary_date date, category string, category_method string")
    path = tmp_path / "month.xlsx"
    with path.open("wb") as target:
        counts = workbooks.write_frames(reports.monthly_sheets(frame), target)
    assert counts == {"Articles": 7, "Source Summary": 2, "Domain Summary": 1, "Daily Summary": 2, "Category Placeholder": 1}
    got = list(workbooks.rows(path.read_bytes()))
    assert got[0] == reports.DETAIL and sorted(r[0] for r in got[1:]) == [f"T{k}" for k in range(7)]


def test_split_by_day(spark, tmp_path):
    header = ["新闻标题", "发布时间", "extra"]
    days = ["2024-01-05 10:00", "45297", "soon", "2024-01-05 08:00", ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xlsx").write_bytes(files.write_workbook({"S": (header, [[f"T{k}", d, k] for k, d in enumerate(days)])}))
    rows = workbooks.read_rows(spark, str(tmp_path / "in"))
    assert rows.count() == 5
    out = tmp_path / "out"
    out.mkdir()
    made = workbooks.split_by_day(rows, workbooks.column(["none", "发布时间"]), str(out), dt.date(2024, 1, 9))
    assert [m.rpartition("_")[2] for m in made] == ["2024-01-05.xlsx", "2024-01-09.xlsx"]
    assert list(workbooks.rows((out / "news_export_2024-01-05.xlsx").read_bytes())) == [header, ["T0", days[0], "0"], ["T3", days[3], "3"]]
    assert list(workbooks.rows((out / "news_export_2024-01-09.xlsx").read_bytes())) == [header] and not list(out.glob("*.part"))
    with pytest.raises(ValueError, match="no dated rows"):
        workbooks.split_by_day(rows.where("pos = 2"), workbooks.column(["发布时间"]), str(out))


def test_mind_maps(spark, tmp_path):
    topic = lambda title, *below: {"title": title} | ({"children": {"attached": list(below)}} if below else {})
    deep = topic("end")
    for k in range(2000):
        deep = topic(f"l{k}", deep)
    with zipfile.ZipFile(tmp_path / "map.xmind", "w") as z:
        z.writestr("content.json", json.dumps([{"rootTopic": topic("R", topic("a", topic("x"), topic("y")), topic("b"))}, {"rootTopic": topic("R", topic("b"))}]))
    assert sum(1 for _ in taxonomy.leaves(deep)) == 1
    found = taxonomy.read_leaves(spark, str(tmp_path / "map.xmind"))
    assert sorted(map(list, (r["path"] for r in found.collect()))) == [["R", "a", "x"], ["R", "a", "y"], ["R", "b"]]
    (tmp_path / "t.json").write_text(json.dumps({"version": "1", "categories": [{"path": ["R", "a", "x"]}, {"path": ["R", "b"]}, {"path": ["R", "c"]}]}))
    allowed = taxonomy.read_taxonomy(spark, str(tmp_path / "t.json"))
    assert sorted((r["kind"], r["path"]) for r in taxonomy.compare(found, allowed).collect()) == [("extra", "R > c"), ("missing", "R > a > y")]
    some = found.where(F.element_at("path", -1) != "y")
    assert taxonomy.verify(found, allowed) == 1 and taxonomy.verify(some, allowed) == 0 and taxonomy.verify(some, allowed, exact=True) == 1
    rows = [("R", None, "R"), ("a", "R", "a"), ("x", "a", "x"), ("y", "a", "y"), ("b", "R", "b"), ("lost", "gone", "l"), ("c1", "c2", "c"), ("c2", "c1", "c")]
    tree = taxonomy.leaves_of(spark.createDataFrame(rows, "topic string, parent string, title string"))
    assert sorted(r["path"] for r in tree.collect()) == [["R", "a", "x"], ["R", "a", "y"], ["R", "b"]]
