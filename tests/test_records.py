"""Parsers of records on hand-made files."""

import datetime

from vellum.sources import records


def test_notices():
    html = """<html><body>
<h1>Title ( a ) of it .</h1>
<p>no attributes</p>
<p class="body">First paragraph</p>
<p class="Footnote"> Note one , two </p>
<table><tr><td>cell</td></tr></table>
<p id="x">no class</p>
<p class="body">First paragraph</p>
<p class="body">(1) part   second part</p>
<h2>End</h2></body></html>"""
    assert records.notices(html) == [
        ("HD", 2, "Title (a) of it.", 2), ("p", 0, "First paragraph", 4), ("Footnote", 8, "Note one, two", 4), ("p", 0, "(1) part", 9), ("p", 0, "second part", 9), ("HD", 2, "End", 10),
    ]
    assert records.notices(None) == [] and records.notices("<table></table>") == []


def test_regulations():
    html = """<p class="normal">Plain text of it</p>
<p class="normal">—</p>
<p class="doc-ti">iv</p>
<p class="tbl-hdr">Table head</p>
<p class="note">a note .</p>
<p class="normal">(a)</p>
<p class="title">CHAPTER One</p>
<p class="normal">one</p><p class="normal">two on a line</p>
<p>none</p>"""
    got = records.regulations(html)
    assert got == [("p", 0, "Plain text of it", 1), ("TABLE", 5, "Table head", 4), ("Footnote", 8, "a note.", 5), ("HD", 2, "CHAPTER One", 7), ("p", 0, "two on a line", 8)]


def test_guidance():
    rows = '<tr><th>Reference</th><th>Title</th><th>Publication</th></tr><tr><td>M 1</td><td>A <b>b</b></td><td>May<a href="x.doc">w</a><a href="/y.PDF">p</a><a href="z.pdf">q</a></td></tr><tr><td>M 2</td><td> </td><td>May</td></tr><tr><td>M 3</td></tr>'
    assert records.guidance(f"<table>{rows}</table>", "https://h.example/d/") == [("M 1", "A b", "May w p q", "https://h.example/y.PDF", "https://h.example/d/x.doc")]
    assert records.guidance(f"<table>{rows.replace('Title', 'Name')}</table>") == []


def test_articles():
    def one(body: str) -> str:
        return f"<PubmedArticle><MedlineCitation>{body}</MedlineCitation></PubmedArticle>"

    xml = "<S>" + one('<PMID Version="2">7</PMID><DateRevised><Year>2001</Year><Month>Feb</Month><Day>x</Day></DateRevised><Article><ArticleTitle> T </ArticleTitle></Article>')
    xml += one("<Article/>") + one("<PMID>8</PMID><DateRevised><Year>none</Year></DateRevised>") + "<DeleteCitation><PMID>1</PMID><PMID>2</PMID></DeleteCitation>" + one("<PMID>9</PMID>") + "</S>"
    got = [dict(zip(records._NAMES, r)) for r in records.articles(xml)]
    assert [(r["pmid"], r["deleted"]) for r in got] == [("7", False), ("1", True), ("2", True), ("9", False)]
    assert got[0]["revised"] == datetime.date(2001, 2, 1) and (got[0]["title"], got[0]["version"], got[0]["doi"]) == ("T", "2", "")
    assert list(records.articles(None)) == [] and list(records.articles("<S><PubmedArticle>")) == []


def test_rows_of_a_batch_come_in_parts(spark, monkeypatch):
    from vellum.sources import markup, records

    for m in (markup, records):
        monkeypatch.setattr(m, "ROWS", 3)
    parser = lambda t: [(w,) for w in t.split()]
    df = spark.createDataFrame([(i, "a b c d e") for i in range(4)], "k long, t string")
    got = sorted(tuple(r) for r in records.scan(df, "k", "t", parser, "w string").collect())
    assert got == [(i, j, w) for i in range(4) for j, w in enumerate("abcde")]
    got = markup.parse(df, "k", "t", lambda t: [("p", 0, w) for w in t.split()]).collect()
    assert sorted((r.k, r.ordinal, r.text) for r in got) == [(i, j, w) for i in range(4) for j, w in enumerate("abcde")]
