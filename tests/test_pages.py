"""Pages as articles, and where a page's date is found."""

import duckdb
import pytest

from newsloom.functions import html, selectors
from newsloom.plans import page_queries, registry  # noqa: F401  (queries are registered on import)

PAGE = """<html><head><title>T</title><link rel="canonical" href="/2024/01/05/real.html"><meta property="og:url" content="https://h.org/x"></head><body>
<nav><p>Menu of the whole site, long enough to count.</p></nav><div class="body-content"><p>The first line of the body.</p><p>Source: elsewhere</p><p>The second line of the body.</p></div>
<div class="wide"><p>A much longer text in a sidebar that would win by its length alone, were it not outside of the boundary.</p><p>And one more long line of it to be sure.</p></div></body></html>"""


def test_page_articles(spark):
    rows = [("https://h.org/2024/01/05/a.html?utm_source=x", PAGE, "Interesting Engineering"), ("https://h.org/2024/01/06/a.html", PAGE, None), ("https://h.org/b", "", "x"), (None, None, None), ("https://h.org/c", "<p>no body element here, though a text</p>", "batteries news")]
    got = {(r["url"], r["source_name"]): r for r in html.page_articles(spark.createDataFrame(rows, "url string, html string, source_name string")).collect()}
    strict = got["https://h.org/2024/01/05/real.html", "Interesting Engineering"]
    assert strict["content"] == "The first line of the body.\nThe second line of the body."
    assert (strict["published_at"], strict["content_status"], strict["content_issue"], strict["title"]) == ("2024-01-05", "full", "", "T")
    free = got["https://h.org/2024/01/06/a.html", ""]  # the declared address has another date
    assert free["published_at"] == "2024-01-06" and "sidebar" in free["content"] and "Menu" not in free["content"]
    assert len(got) == 2


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ('<span id="PublishedDate"> 05/01/2024 </span>', "05/01/2024"), ('<span id="PublishDate">soon</span><i id="publish-date">05/01/2024</i>', ""),
        ('<i class="x pubtime">on 2024-01-05 10:30 by me</i>', "2024-01-05 10:30"), ('<i class="time">2024/1/5</i><i class="article-time">2024.1.6</i>', "2024.1.6"), ('<i class="dates">2024-01-05</i>', ""),
    ],
)
def test_dates_in_elements(page, expected):
    assert html.published(html.parse(page)) == expected


def test_selectors():
    root = html.parse('<div class="outer"><p><b class="inner left" id="k">x</b></p></div>')
    found = lambda s: [n.tag for n in selectors.select(root, s)]
    assert all(found(s) == ["b"] for s in ("#k", ".inner", ".inner.left", ".outer .inner", ".outer #k"))
    assert not any("b" in found(s) for s in ("#l", ".outer", ".inner.right", ".inner .inner"))


def cut_pages(folder, spark):
    """Pages in the form of the table, whose headings and texts were cut within a reference."""
    heads = ["A heading &amp; more of it &amp", "Cut &am", "&quot;Said&quo", "One &&amp;&amp", "R&ampD &lt 5 &copy 6 &#39 7"]
    rows = [(i, f"https://h.org/{i}", f"<!DOCTYPE html><html><head><title>x &amp</title><script>if (a && b &amp) {{}}</script></head><body><nav><a href=\"/\">Home</a></nav><article><h1>{h}</h1><p>{'A line of the body, long enough. ' * 4}{h}</p></article><footer>&copy; x</footer></body></html>") for i, h in enumerate(heads)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def against_sql(spark, folder, name):
    """A query's rows over a folder, and those of its SQL."""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    got = registry.queries()[name](spark, str(folder))
    return sorted(map(tuple, got.collect())), sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.oracle_sql()[name]})").fetchall())


def test_full_texts_keep_cut_references(spark, tmp_path):
    cut_pages(tmp_path, spark)
    got, expected = against_sql(spark, tmp_path, "page_full_texts")
    assert got == expected and got[0][1].endswith("A heading & more of it &amp")


def test_titles_keep_cut_references(spark, tmp_path):
    cut_pages(tmp_path, spark)
    got, expected = against_sql(spark, tmp_path, "page_titles")
    assert got == expected and got[0] == (0, "A heading & more of it &amp")


def test_references_without_semicolon():
    page = '<a&b title="R&ampD &amp; x" href="/?a=1&lt=2"></a&b><p>A &amp B &amp; C &notit; &#39 &#39; &eacute;</p><script type="ld+json">"&amp; & &amp"</script>'
    texts = [n.text() for terminated in (False, True) for n in html.parse(page, terminated).walk() if n.tag in ("p", "script")]
    assert texts == ["A & B & C ¬it; ' ' é", '"&amp; & &amp"', "A &amp B & C &notit; &#39 ' é", '"&amp; & &amp"']
    assert html.parse(page, True).children[0].attrs == {"title": "R&ampD & x", "href": "/?a=1&lt=2"}
    assert [n.tag for n in html.parse(page, True).children] == ["a&b", "p", "script"]
