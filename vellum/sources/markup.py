"""Scans of HTML, XML, LaTeX and DOCX into source tables; one document is parsed in one place, partitions at a time."""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task gives back at once.
ROWS = 5_000
BLOCKS = "ordinal int, tag string, cls int, text string"
# Tags of headings and blocks, and tags whose text is no text.
HEADINGS = tuple(f"h{i}" for i in range(1, 10))
TEXT_BLOCKS = ("p", "li", "td", "th", "blockquote", "pre", "dd", "dt")
SKIPPED = ("script", "style", "nav", "footer", "noscript", "template")
SPACE = re.compile(r"\s+")


class _Html(HTMLParser):
    """Blocks in document order: headings are 2, footnotes 8, tables 5, other blocks 0."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open, self.skip = [], None, 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        elif tag in HEADINGS or tag in TEXT_BLOCKS:
            self.close_block()
            note = "footnote" in (dict(attrs).get("class") or "")
            self.open = [tag, 2 if tag in HEADINGS else 8 if note else 5 if tag in ("td", "th") else 0, []]

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif self.open and tag == self.open[0]:
            self.close_block()

    def handle_data(self, data):
        if self.open and not self.skip:
            self.open[2].append(data)

    def close_block(self):
        if self.open and (text := SPACE.sub(" ", "".join(self.open[2])).strip()):
            self.found.append((self.open[0], self.open[1], text))
        self.open = None


def html_blocks(html: str | None) -> list[tuple[str, int, str]]:
    p = _Html()
    p.feed(html or "")
    p.close()
    p.close_block()
    return p.found


# Tags of the regulation markup and their classes; unlisted tags are walked through.
XML_CLASSES = {"HD": 2, "HEAD": 2, "SUBJECT": 2, "P": 0, "FP": 0, "AUTH": 9, "CONTENTS": 9, "FTNT": 8, "GPOTABLE": 5, "TOC": 4}


def xml_blocks(xml: str | None, classes: dict[str, int] = XML_CLASSES) -> list[tuple[str, int, str]]:
    """Blocks by their tags; a block's own blocks are part of it. Malformed markup gives none."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return []
    out = []

    def walk(e) -> None:
        tag = e.tag.rpartition("}")[2]
        if tag in classes:
            if text := SPACE.sub(" ", "".join(e.itertext())).strip():
                out.append((tag, classes[tag], text))
        else:
            for x in e:
                walk(x)

    walk(root)
    return out


LATEX_STEPS = (
    (r"(?<!\\)%.*", ""), (r"\\(?:label|ref|cite[a-z]*|includegraphics)(?:\[[^\]]*\])?\{[^}]*\}", ""), (r"\\(?:begin|end)\{[^}]*\}(?:\[[^\]]*\])?", "\n"),
    (r"\\item\s*", "\n- "), (r"\\\\", "\n"), (r"~", " "), (r"\\(?:textbf|textit|emph|texttt|underline)\{([^{}]*)\}", r"\1"), (r"\$([^$]*)\$", r"\1"),
    (r"\\([%&#_$])", r"\1"), (r"\\[a-zA-Z]+\*?", ""), (r"[{}]", ""), (r"[ \t]+", " "),
)


def latex_to_text(s: str) -> str:
    """Ordered rewriting steps; nested formatting is unwound until nothing changes."""
    for pattern, to in LATEX_STEPS:
        while True:
            t = re.sub(pattern, to, s)
            if t == s or not pattern.startswith(r"\\(?:textbf"):
                s = t
                break
            s = t
    return s.strip()


def latex_blocks(tex: str | None) -> list[tuple[str, int, str]]:
    """Sections as headings, items as list entries, other paragraphs."""
    out = []
    for part in re.split(r"\n\s*\n|(?=\\(?:sub)*section\*?\{)|(?=\\item\b)", tex or ""):
        if m := re.match(r"\\((?:sub)*section)\*?\{((?:[^{}]|\{[^{}]*\})*)\}", part):
            out.append((m[1], 2, latex_to_text(m[2])))
            part = part[m.end() :]
        kind = ("item", 10) if part.lstrip().startswith(r"\item") else ("par", 0)
        if text := SPACE.sub(" ", latex_to_text(part)).strip(" -"):
            out.append((*kind, text))
    return [x for x in out if x[2]]


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_blocks(content: bytes | None) -> list[tuple[str, int, str]]:
    """Paragraphs of a DOCX in order: contents before headings before tables before plain ones; headers and footers last."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
        for name, scope in (("word/document.xml", None), *((n, 6 if "header" in n else 7) for n in sorted(z.namelist()) if re.match(r"word/(header|footer)\d*\.xml$", n))):
            if name not in z.namelist():
                continue
            root = ElementTree.fromstring(z.read(name))
            inside = {id(p) for t in root.iter(f"{_W}tbl") for p in t.iter(f"{_W}p")}
            for p in root.iter(f"{_W}p"):
                text = "".join("\t" if x.tag == f"{_W}tab" else "\n" if x.tag == f"{_W}br" else x.text or "" for x in p.iter() if x.tag in (f"{_W}t", f"{_W}tab", f"{_W}br"))
                style = next((x.get(f"{_W}val") or "" for x in p.iter(f"{_W}pStyle")), "")
                toc = style.startswith("TOC") or any("TOC" in (x.text or "") for x in p.iter(f"{_W}instrText"))
                cls = scope if scope is not None else 4 if toc else 2 if style.lower().startswith(("heading", "title")) else 5 if id(p) in inside else 0
                if text.strip():
                    out.append(("p", cls, text.strip()))
    return out


def parse(df: DataFrame, key: str, content: str, parser: Callable) -> DataFrame:
    """(key, ordinal, tag, cls, text): a parser over each document. Parsers are plug-ins: content to blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = ((k, i, *x) for k, c in zip(b[key], b[content]) for i, x in enumerate(parser(c)))
            # a batch of documents may hold any number of blocks
            while part := list(islice(rows, ROWS)):
                yield pd.DataFrame(part, columns=[key, "ordinal", "tag", "cls", "text"])

    return df.select(key, content).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, {BLOCKS}")


def first_of_equal(blocks: DataFrame, key: str) -> DataFrame:
    """Of blocks with the same text in a document, the first."""
    return blocks.groupBy(key, "text").agg(F.min("ordinal").alias("ordinal"), F.min_by("cls", "ordinal").alias("cls"))


def plain_html(html: Column) -> Column:
    """Text of markup without scripts, styles and comments, as a column."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>?", " "), r"\s+", " "))


PARSERS: dict[str, Callable] = {"html": html_blocks, "xml": xml_blocks, "latex": latex_blocks, "docx": docx_blocks}

cloudpickle.register_pickle_by_value(sys.modules[__name__])
