"""Scans of article records, classed paragraphs of web regulations, guidance lists and office files, as plug-ins.

Each parser turns one file's content into rows; ``scan`` runs a parser over a table of files, in Arrow batches. A file
that cannot be parsed gives no rows; an article that cannot be parsed is left out."""

from __future__ import annotations

import datetime
import io
import re
import sys
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import urljoin
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Short names of months, and the paths of an article's plain fields.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
PLAIN = {
    "title": "Article/ArticleTitle", "journal": "Article/Journal/Title", "journal_short": "Article/Journal/ISOAbbreviation",
    "volume": "Article/Journal/JournalIssue/Volume", "issue": "Article/Journal/JournalIssue/Issue", "pages": "Article/Pagination/MedlinePgn",
}
#: Rows that a task gives back at once.
ROWS = 5_000
ARTICLE = "pmid string, version string, deleted boolean, doi string, title string, abstract string, journal string, journal_short string, journal_date string, volume string, issue string, pages string, created date, revised date, authors array<string>, other_abstracts array<string>"
_NAMES = [x.split()[0] for x in ARTICLE.split(", ")]


def _text(e, path: str) -> str | None:
    found = e.find(path) if e is not None else None
    return found.text.strip() if found is not None and found.text else None


def _number(t: str | None) -> int | None:
    try:
        return int(t or "")
    except ValueError:
        return None


def lenient_date(e) -> datetime.date | None:
    """The date of an element with Year, Month and Day; a month by number or short name, else 1; a day by number, else 1."""
    if e is None:
        return None
    month = _text(e, "Month")
    named = MONTHS.index(month.lower()) + 1 if month and month.lower() in MONTHS else 1
    return datetime.date(int(_text(e, "Year") or ""), _number(month) or named, _number(_text(e, "Day")) or 1)


def _article(e) -> dict | None:
    med = e.find("MedlineCitation")
    pmid = _text(med, "PMID")
    if pmid is None:
        return None
    out = {k: _text(med, path) for k, path in PLAIN.items()}
    parts = [t for x in med.findall("Article/Abstract/AbstractText") if (t := (x.text or "").strip())]
    issued = med.find("Article/Journal/JournalIssue/PubDate")
    dated = [_text(issued, k) for k in ("Year", "Month", "Day")]
    places = med.findall("Article/ELocationID")
    # the last place counts, and only if it is a doi
    doi = ((places[-1].text or "").strip() if places[-1].get("EIdType") == "doi" else "") if places else _text(med, "PubmedData/ArticleIdList/ArticleId[@IdType='doi']") or ""
    named = [(_text(a, "LastName"), _text(a, "ForeName")) for a in med.findall("Article/AuthorList/Author")]
    return out | {
        "pmid": pmid, "version": med.find("PMID").get("Version"), "deleted": False, "doi": doi, "abstract": "\n".join(parts) or None,
        "journal_date": "-".join(x for x in dated if x) if dated[0] else _text(issued, "MedlineDate"),
        "created": lenient_date(med.find("DateCreated")), "revised": lenient_date(med.find("DateRevised")),
        "authors": [", ".join(x for x in a if x) for a in named], "other_abstracts": ["".join(x.itertext()).strip() for x in med.findall("Article/OtherAbstract")],
    }


def articles(xml: str | bytes | None) -> Iterator[tuple]:
    """One row for each article, and one for each deleted id, as the stream comes by; nothing of it is kept."""
    raw = xml.encode() if isinstance(xml, str) else xml or b""
    stream = ElementTree.iterparse(io.BytesIO(raw), events=("start", "end"))
    try:
        _, root = next(stream)
        for event, e in stream:
            if event == "start" or e.tag not in ("PubmedArticle", "PubmedBookArticle", "DeleteCitation"):
                continue
            if e.tag == "DeleteCitation":
                found = [{"pmid": x.text, "deleted": True} for x in e if x.tag == "PMID"]
            else:
                try:
                    found = [a] if (a := _article(e)) else []
                except ValueError:
                    found = []
            yield from (tuple(r.get(k) for k in _NAMES) for r in found)
            root.clear()
    except (ElementTree.ParseError, StopIteration):
        return


class _Page(HTMLParser):
    """The elements of a page with the texts within them: [tag, attributes, line, texts, children]."""

    VOID = ("br", "img", "hr", "input", "meta", "link", "col", "area", "base", "wbr", "source")

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.all: list = []
        self.open: list = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "p" and any(e[0] == "p" for e in self.open):
            self.handle_endtag("p")
        e = [tag, dict(attrs), self.getpos()[0], [], []]
        if self.open:
            self.open[-1][4].append(e)
        self.all.append(e)
        if tag not in self.VOID:
            self.open.append(e)

    def handle_endtag(self, tag):
        if any(e[0] == tag for e in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for e in self.open:
            e[3].append(data)

    def within(self, e: list, *tags: str) -> list:
        return [x for c in e[4] for x in ([c] if c[0] in tags else []) + self.within(c, *tags)]


# A first word that is a number or letter of a list, a single first word, roman numbers, and spaces
# before marks and inside of brackets.
COMPOUND = re.compile(r"^(([+()%!-^{}-•.][\d]+|([()+%!-^{}-•.][a-zA-Z]+))|[\d]+|[a-zA-Z])((\.[0-9a-zA-Z]+)+)?(?:[()+%![\]{}-•.]?\s)")
FIRST_WORD = re.compile(r"^[A-Za-z\d]+(?:\s)")
ROMAN = re.compile(r"^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$")
MARKS = re.compile(r'(\s([?,.!"]))|(?<=\[|\()(.*?)(?=\)|\])')
CLASSED = "tag string, cls int, text string, line int"


def is_compound(t: str) -> bool:
    """Whether a text starts with a mark of a list: a number or letter with a mark before or behind it."""
    return bool(COMPOUND.match(t)) and not FIRST_WORD.match(t) and not t.isdigit()


def _split(t: str) -> list[str]:
    """A text that starts with such a mark, cut where three spaces stand; others whole."""
    return re.sub(r"\s", " ", t).split("   ") if is_compound(t) else [t]


def _plain(texts: list[str]) -> str:
    return " ".join(texts).replace("\n", "")


def _tidy(t: str) -> str:
    return MARKS.sub(lambda m: m.group().strip(), t.strip())


def notices(html: str | None) -> list[tuple[str, int, str, int]]:
    """(tag, class, text, line) of a page of notices: headings 2, footnotes 8, paragraphs with a class 0, and a table
    as 5 with the text before it; of equal texts the first. Paragraphs without attributes are no part of it."""
    out: dict[str, tuple] = {}
    text, line = None, None
    for tag, attrs, at, texts, _ in _Page(html or "").all:
        if tag == "p" and attrs and "class" not in attrs:
            continue
        if re.fullmatch(r"h[1-9]", tag) or (tag == "p" and attrs and (attrs["class"] or "").lower() != "footnote"):
            line = at  # footnotes keep the line before them
        if tag == "p" and attrs:
            note = (attrs["class"] or "").lower() == "footnote"
            text = _tidy(_plain(texts)) if note else _plain(texts)
            kind = ("Footnote", 8) if note else ("p", 0)
        elif re.fullmatch(r"h[1-9]", tag):
            text, kind = _tidy(_plain(texts)), ("HD", 2)
        elif tag == "table" and text is not None:
            out.setdefault(text, ("TABLE", 5, text, line))
            continue
        else:
            continue
        if line is None:
            continue
        for part in (parts := _split(text)):
            out.setdefault(part, (*kind, part, line))
        text = re.sub(r"\s", " ", text) if len(parts) > 1 else text
    return list(out.values())


def regulations(html: str | None) -> list[tuple[str, int, str, int]]:
    """(tag, class, text, line) of paragraphs by their class: normal 0, tables 5, notes 8, else headings 2; dashes, roman
    numbers alone and marks of lists alone are left out; of several on a line the last."""
    rows: list[tuple[str, int, str, int]] = []
    seen: set[int] = set()
    for tag, attrs, line, texts, _ in _Page(html or "").all:
        kind = attrs.get("class") if tag == "p" else None
        raw = _plain(texts)
        if kind is None or raw == "—" or ROMAN.match(raw.upper()):
            continue

        def add(tag: str, cls: int, text: str) -> bool:
            if not is_compound(text) and is_compound(text + " "):
                return False
            rows.extend((tag, cls, t, line) for t in _split(text))
            seen.add(line)
            return True

        if "normal" in kind and not add("p", 0, raw):
            continue
        if "tbl" in kind:
            rows.append(("TABLE", 5, raw, line))
            seen.add(line)
        if "note" in kind:
            add("Footnote", 8, _tidy(raw))
        elif line not in seen:
            add("HD", 2, _tidy(raw))
    last = {r[3]: r for r in rows}
    return [r for i, r in enumerate(rows) if last[r[3]] is r]


GUIDANCE = "reference string, title string, published string, pdf string, docx string"
# Headers that a table of guidance has, and ends of the files it links.
HEADERS, FILES = {"Reference", "Title", "Publication"}, {"pdf": (".pdf",), "docx": (".docx", ".doc")}


def guidance(html: str | None, base: str = "") -> list[tuple]:
    """(reference, title, published, pdf, docx) of the tables with the wanted headers: rows of three cells or more,
    all three filled; the first link of each kind of file."""
    page, out = _Page(html or ""), []
    for table in (e for e in page.all if e[0] == "table"):
        if not HEADERS <= {"".join(t.strip() for t in e[3]) for e in page.within(table, "th")}:
            continue
        for row in page.within(table, "tr")[1:]:
            cells = page.within(row, "td")
            if len(cells) < 3:
                continue
            first = [" ".join(t.strip() for t in c[3] if t.strip()) for c in cells[:3]]
            links = [(e[1].get("href") or "").strip() for c in cells for e in page.within(c, "a")]
            files = [next((urljoin(base, x) for x in links if x.lower().endswith(ends)), None) for ends in FILES.values()]
            if all(first):
                out.append((*first, *files))
    return out


_DOCX = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx_file(paragraphs: list[tuple[str, str]]) -> bytes:
    """A DOCX of paragraphs (style, text); the style "cell" makes a table of one cell. The time in it is fixed."""
    from xml.sax.saxutils import escape

    def paragraph(style: str, text: str) -> str:
        return f'<w:p><w:pPr><w:pStyle w:val="{escape(style)}"/></w:pPr><w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>'

    body = "".join(f"<w:tbl><w:tr><w:tc>{paragraph('', t)}</w:tc></w:tr></w:tbl>" if s == "cell" else paragraph(s, t) for s, t in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("word/document.xml", (2000, 1, 1, 0, 0, 0)), f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{_DOCX}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def scan(df: DataFrame, key: str, content: str, parser: Callable, columns: str) -> DataFrame:
    """(key, ordinal, columns): the rows of a parser over each file."""
    names = [key, "ordinal", *(x.split()[0] for x in columns.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = ((k, i, *r) for k, c in zip(b[key], b[content]) for i, r in enumerate(parser(c)))
            # a batch of files may hold any number of rows
            while part := list(islice(rows, ROWS)):
                yield pd.DataFrame(part, columns=names)

    return df.select(key, content).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, ordinal int, {columns}")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
