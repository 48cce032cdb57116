"""Workbooks read and written row by row: memory holds a row (and where shared texts lie), however long a sheet is.

Reading follows the events of the sheet's XML inside the zip; shared texts are moved to a file of the task's own and
looked up by offset; numbers whose style is a date are read as one. Writing streams rows into the zip, with a bold
header, frozen and filtered, columns as wide as their first rows and addresses as links.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import re
import tempfile
import zipfile
from array import array
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.free_dates import free_date

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
#: Number formats that are dates, rows and links that a sheet can hold, widths, and rows that decide them.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
MOST_ROWS, MOST_LINKS, WIDTHS, MEASURED = 1_048_576, 65_530, (10, 60), 200
#: Rows of a workbook that go to Spark at a time.
BATCH = 1000


class SharedTexts:
    """Shared texts of a workbook in a temporary file, by number."""

    def __init__(self, book: zipfile.ZipFile) -> None:
        self.file, self.starts = tempfile.TemporaryFile(), array("Q", [0])
        if "xl/sharedStrings.xml" not in book.namelist():
            return
        with book.open("xl/sharedStrings.xml") as source:
            for node in _elements(source, "si"):
                text = "".join(t.text or "" for t in node.iter(f"{_MAIN}t") if t is not None).encode()
                self.file.write(text)
                self.starts.append(self.starts[-1] + len(text))

    def __getitem__(self, number: int) -> str:
        self.file.seek(self.starts[number])
        return self.file.read(self.starts[number + 1] - self.starts[number]).decode()

    def close(self) -> None:
        self.file.close()


def _elements(source, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a tag as they end; what has been given is forgotten."""
    events = ElementTree.iterparse(source, events=("start", "end"))
    _, root = next(events)
    open_ = [root]
    for event, node in events:
        if event == "start":
            open_.append(node)
        else:
            open_.pop()
            if node.tag == _MAIN + tag:
                yield node
                open_[-1].remove(node)


def date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(n.get("numFmtId", 0)): n.get("formatCode", "") for n in root.iter(f"{_MAIN}numFmt")}
    shows = {i for i, code in own.items() if re.search(r"[ymdhs]", re.sub(r"\"[^\"]*\"|\[[^\]]*\]|\\.", "", code.lower()))}
    formats = root.find(f"{_MAIN}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", 0)) in DATE_FORMATS | shows}


def serial_date(number: float, from_1904: bool = False) -> str:
    """A day number as a date, with the time if it has one. Day 60 is the one that never was; days before it are one early."""
    if not 0 <= number < 2_958_466:
        return repr(number)
    begin = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30) + dt.timedelta(days=number < 60)
    moment = begin + dt.timedelta(seconds=round(number * 86_400))
    return moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(sep=" ")


def first_sheet(book: zipfile.ZipFile) -> tuple[str, str, bool]:
    """Name and path of the sheet that a workbook opens with, and whether its days count from 1904."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    view = root.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
    sheets = list(root.iter(f"{_MAIN}sheet"))
    at = min(int(view.get("activeTab", 0)) if view is not None else 0, len(sheets) - 1)
    paths = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACKAGE}Relationship")}
    target = paths[sheets[at].get(f"{_REL}id")]
    setting = root.find(f"{_MAIN}workbookPr")
    return sheets[at].get("name", ""), target.lstrip("/") if target.startswith("/") else f"xl/{target}", setting is not None and setting.get("date1904") in ("1", "true")


def rows(source) -> Iterator[list[str]]:
    """Rows of the sheet that a workbook (bytes or a file) opens with, as texts; empty cells are empty."""
    with zipfile.ZipFile(io.BytesIO(source) if isinstance(source, bytes) else source) as book:
        _, path, from_1904 = first_sheet(book)
        texts, dates = SharedTexts(book), date_styles(book)
        try:
            with book.open(path) as sheet:
                for row in _elements(sheet, "row"):
                    cells: dict[int, str] = {}
                    at = -1
                    for cell in row.iter(f"{_MAIN}c"):
                        letters = re.match(r"[A-Z]+", cell.get("r", ""))
                        at = _column(letters[0]) if letters else at + 1
                        cells[at] = _value(cell, texts, dates, from_1904)
                    yield [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]
        finally:
            texts.close()


def _column(letters: str) -> int:
    return sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters))) - 1


def _letters(column: int) -> str:
    out = ""
    while column >= 0:
        out, column = chr(65 + column % 26) + out, column // 26 - 1
    return out


def _value(cell: ElementTree.Element, texts: SharedTexts, dates: set[int], from_1904: bool) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    raw = cell.findtext(f"{_MAIN}v") or ""
    if not raw or kind == "e":
        return ""
    if kind == "s":
        return texts[int(raw)]
    if kind == "b":
        return "TRUE" if raw == "1" else "FALSE"
    if kind == "n" and int(cell.get("s", 0)) in dates:
        return serial_date(float(raw), from_1904)
    return raw


class Book:
    """A workbook that is written sheet by sheet and row by row."""

    STYLES = (
        f'<?xml version="1.0"?><styleSheet xmlns="{_MAIN[1:-1]}"><fonts count="3"><font/><font><b/></font><font><u/><color rgb="FF0563C1"/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
        '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="4"><xf/><xf fontId="1" applyFont="1" applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf><xf applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf>'
        '<xf fontId="2" applyFont="1" applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf></cellXfs></styleSheet>'
    )

    def __init__(self, target) -> None:
        self.zip, self.names = zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, allowZip64=True), []

    def sheet(self, name: str, header: list[str], content: Iterable[Iterable], *, link: str = "url") -> int:
        """Writes a sheet and says how many rows it has; more than a sheet can hold go on in further ones."""
        content = iter(content)
        first = list(itertools.islice(content, MEASURED))
        widths = [min(max([len(str(v[i])) for v in [header, *map(list, first)] if i < len(v) and v[i] is not None] + [0]) + 2, WIDTHS[1]) for i in range(len(header))]
        at = header.index(link) if link in header else None
        written, content, part = 0, itertools.chain(first, content), 1
        while True:
            n, more = self._part(name if part == 1 else f"{name} {part}", header, content, [max(w, WIDTHS[0]) for w in widths], at)
            written, part = written + n, part + 1
            if more is None:
                return written
            content = itertools.chain([more], content)

    def _part(self, name: str, header: list[str], content: Iterator, widths: list[int], at: int | None) -> tuple[int, object]:
        self.names.append(name)
        number, links, count, more = len(self.names), tempfile.TemporaryFile("w+", encoding="utf-8", newline="\n"), 0, None
        with self.zip.open(f"xl/worksheets/sheet{number}.xml", "w", force_zip64=True) as out:
            put = lambda text: out.write(text.encode())
            put(f'<?xml version="1.0"?><worksheet xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><cols>')
            put("".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1)) + "</cols><sheetData>")
            put(self._row(1, header, 1, None))
            linked = 0
            for row in content:
                if count + 2 > MOST_ROWS:
                    more = row
                    break
                count += 1
                values = list(row)
                address = str(values[at]) if at is not None and at < len(values) and values[at] is not None else ""
                is_link = address.startswith(("http://", "https://")) and linked < MOST_LINKS
                put(self._row(count + 1, values, 2, at if is_link else None))
                if is_link:
                    linked += 1
                    links.write(f"{count + 1}\t{address.split(chr(10))[0]}\n")
            put(f'</sheetData><autoFilter ref="A1:{_letters(max(len(header) - 1, 0))}{count + 1}"/>')
            if linked:
                links.seek(0)
                put("<hyperlinks>")
                for i, line in enumerate(links, 1):
                    put(f'<hyperlink ref="{_letters(at)}{line.partition(chr(9))[0]}" r:id="l{i}"/>')
                put("</hyperlinks>")
            put("</worksheet>")
        if linked:
            links.seek(0)
            with self.zip.open(f"xl/worksheets/_rels/sheet{number}.xml.rels", "w") as out:
                out.write(f'<?xml version="1.0"?><Relationships xmlns="{_PACKAGE[1:-1]}">'.encode())
                for i, line in enumerate(links, 1):
                    out.write(f'<Relationship Id="l{i}" Type="{_REL[1:-1]}/hyperlink" Target={quoteattr(line.rstrip(chr(10)).partition(chr(9))[2])} TargetMode="External"/>'.encode())
                out.write(b"</Relationships>")
        links.close()
        return count, more

    @staticmethod
    def _row(number: int, values: list, style: int, link: int | None) -> str:
        cells = []
        for i, value in enumerate(values):
            own = f'r="{_letters(i)}{number}" s="{3 if i == link else style}"'
            if isinstance(value, int | float) and not isinstance(value, bool) and value == value:
                cells.append(f"<c {own}><v>{value}</v></c>")
            elif value is not None and value == value:
                text = escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(value))[:32_767])
                cells.append(f'<c {own} t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>')
        return f'<row r="{number}">{"".join(cells)}</row>'

    def close(self) -> None:
        parts = range(1, len(self.names) + 1)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        self.zip.writestr("xl/styles.xml", self.STYLES)
        self.zip.writestr(
            "[Content_Types].xml",
            '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in parts) + "</Types>",
        )
        self.zip.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="r1" Type="{_REL[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self.zip.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>' + "".join(f'<sheet name={quoteattr(n[:31])} sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(self.names, 1)) + "</sheets></workbook>")
        self.zip.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<?xml version="1.0"?><Relationships xmlns="{_PACKAGE[1:-1]}">' + "".join(f'<Relationship Id="r{i}" Type="{_REL[1:-1]}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in parts)
            + f'<Relationship Id="s" Type="{_REL[1:-1]}/styles" Target="styles.xml"/></Relationships>',
        )
        self.zip.close()


def write_frames(frames: dict[str, DataFrame], target) -> dict[str, int]:
    """Writes frames as the sheets of a workbook and says how many rows each has.

    Rows come to the driver a partition at a time and go straight into the file. A workbook is for a person to open;
    what is larger belongs in files that Spark writes.
    """
    book, out = Book(target), {}
    for name, frame in frames.items():
        out[name] = book.sheet(name, frame.columns, (tuple(r) for r in frame.toLocalIterator()))
    book.close()
    return out


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """``rows_of`` the workbooks of a folder, or one."""
    return rows_of(spark.read.format("binaryFile").load(path))


def rows_of(books: DataFrame) -> DataFrame:
    """Rows of workbooks (``path, content``), a book a task: ``path, pos, header array<string>, cells array<string>`` from
    the second row on. A task gives rows in batches of ``BATCH``; a workbook without rows gives nothing.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                content = rows(bytes(data))
                header = next(content, None)
                for start in itertools.count(0, BATCH):
                    part = list(itertools.islice(content, BATCH)) if header is not None else []
                    if not part:
                        break
                    yield pd.DataFrame({"path": name, "pos": range(start, start + len(part)), "header": [header] * len(part), "cells": [[*r, *[""] * (len(header) - len(r))] for r in part]})

    return books.select("path", "content").mapInPandas(run, "path string, pos long, header array<string>, cells array<string>")


def column(names: list[str]) -> Column:
    """The cell of a row under the first header that has one of some names; null if none has."""
    places = [F.array_position(F.transform("header", lambda h: F.trim(h)), n) for n in names]
    at = F.coalesce(*(F.when(p > 0, p) for p in places))
    return F.try_element_at(F.col("cells"), at.cast("int"))


def split_by_day(book_rows: DataFrame, published: Column, folder: str, required: dt.date | None = None) -> list[str]:
    """Writes the rows of an export as one workbook a day, ``news_export_<day>.xlsx``, and says which files there are.

    Rows of a day keep their order and all of their columns; rows without a date are left out; the required day has a
    workbook even if it has no rows. Days are written by tasks, each streaming its rows; the finished workbooks pass
    through the driver one at a time. No dated row and no required day is an error.
    """
    dated = book_rows.withColumn("_day", free_date(published)).where("_day IS NOT NULL")
    dated = dated.select(F.col("_day").cast("string").alias("day"), "path", "pos", "header", "cells")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (r for frame in frames for r in frame.itertuples(index=False))
        for day, own in itertools.groupby(every, key=lambda r: r.day):
            first = next(own)
            with tempfile.TemporaryFile() as out:
                book = Book(out)
                book.sheet("Sheet", list(first.header), (list(r.cells) for r in itertools.chain([first], own)), link="")
                book.close()
                out.seek(0)
                yield pd.DataFrame({"day": [day], "content": [out.read()]})

    books = dated.repartition("day").sortWithinPartitions("day", "path", "pos").mapInPandas(run, "day string, content binary")
    spark, made = book_rows.sparkSession, {}
    for r in books.toLocalIterator():
        made[r["day"]] = f"{folder}/news_export_{r['day']}.xlsx"
        _store(spark, made[r["day"]], bytes(r["content"]))
    if required is not None and required.isoformat() not in made:
        header = book_rows.select("header").first()
        out = io.BytesIO()
        book = Book(out)
        book.sheet("Sheet", list(header[0]) if header else [], [], link="")
        book.close()
        made[required.isoformat()] = f"{folder}/news_export_{required}.xlsx"
        _store(spark, made[required.isoformat()], out.getvalue())
    if not made:
        raise ValueError("the workbook has no dated rows")
    return [made[d] for d in sorted(made)]


def _store(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a file beside its place and moves it there, so no reader sees half of it."""
    jvm = spark.sparkContext._jvm
    final, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    for start in range(0, len(content), 1 << 20):
        out.write(bytearray(content[start : start + (1 << 20)]))
    out.close()
    fs.delete(final, False)
    fs.rename(part, final)
