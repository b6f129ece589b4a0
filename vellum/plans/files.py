"""Queries that scan files of records: article sets, classed pages, guidance lists and office files, made from tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from vellum.plans.registry import query
from vellum.sources import markup, records
from vellum.sources.tables import LINES, lines_of, table


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("""WITH o AS (SELECT o_custkey AS file, o_orderkey AS k, o_orderdate AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INT - 1 AS ordinal FROM orders)
SELECT file, ordinal, k::VARCHAR AS pmid, CASE WHEN k % 9 = 0 THEN NULL ELSE (1 + k % 3)::VARCHAR END AS version, k % 9 = 0 AS deleted, CASE WHEN k % 9 = 0 THEN NULL WHEN k % 4 = 0 THEN '' ELSE '10.1/' || k END AS doi,
 CASE WHEN k % 9 <> 0 THEN 'Article & ' || k END AS title, CASE WHEN k % 9 <> 0 AND k % 5 <> 0 THEN 'One.' || chr(10) || 'Two ' || k END AS abstract,
 CASE WHEN k % 9 = 0 THEN NULL WHEN k % 6 = 0 THEN 'Winter ' || year(d) ELSE year(d) || '-' || strftime(d, '%b') || CASE WHEN k % 2 = 0 THEN '-' || day(d) ELSE '' END END AS journal_date,
 CASE WHEN k % 9 <> 0 THEN make_date(year(d), CASE k % 3 WHEN 2 THEN 1 ELSE month(d) END, CASE WHEN k % 2 = 0 THEN day(d) ELSE 1 END) END AS revised,
 CASE WHEN k % 9 <> 0 THEN 'Doe, J' || k || '|Roe' END AS authors FROM o""")
def article_records(spark, d):
    """Article sets streamed: deleted ids, versions, abstracts of parts, lenient dates, authors. The files
    are written from orders, one for each customer."""
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    s = k.cast("string")
    text = lambda *x: F.concat(*(F.lit(t) if isinstance(t, str) else t for t in x))
    month = F.when(k % 3 == 0, F.month(o).cast("string")).when(k % 3 == 1, F.date_format(o, "MMM")).otherwise("Winter")
    day = F.when(k % 2 == 0, text("<Day>", F.day(o).cast("string"), "</Day>")).otherwise("")
    year = text("<Year>", F.year(o).cast("string"), "</Year>")
    issued = F.when(k % 6 == 0, text("<MedlineDate>Winter ", F.year(o).cast("string"), "</MedlineDate>")).otherwise(text(year, "<Month>", F.date_format(o, "MMM"), "</Month>", day))
    doi = F.when(k % 4 == 0, text('<ELocationID EIdType="pii">S', s, "</ELocationID>")).otherwise(text('<ELocationID EIdType="doi">10.1/', s, "</ELocationID>"))
    abstract = F.when(k % 5 == 0, "").otherwise(text("<Abstract><AbstractText>One.</AbstractText><AbstractText> </AbstractText><AbstractText>Two ", s, "</AbstractText></Abstract>"))
    article = text(
        '<PubmedArticle><MedlineCitation><PMID Version="', (1 + k % 3).cast("string"), '">', s, "</PMID><DateRevised>", year, "<Month>", month, "</Month>", day, "</DateRevised>",
        "<Article><Journal><JournalIssue><PubDate>", issued, "</PubDate></JournalIssue></Journal><ArticleTitle>Article &amp; ", s, "</ArticleTitle>", doi, abstract,
        "<AuthorList><Author><LastName>Doe</LastName><ForeName>J", s, "</ForeName></Author><Author><LastName>Roe</LastName></Author></AuthorList></Article></MedlineCitation></PubmedArticle>",
    )
    one = F.when(k % 9 == 0, text("<DeleteCitation><PMID>", s, "</PMID></DeleteCitation>")).otherwise(article)
    files = table(spark, d, "orders").select(F.col("o_custkey").alias("file"), k, one.alias("xml")).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "xml"))).alias("x"))
    files = files.select("file", text("<PubmedArticleSet>", F.array_join(F.transform("x", lambda x: x["xml"]), ""), "</PubmedArticleSet>").alias("xml"))
    found = records.scan(files, "file", "xml", records.articles, records.ARTICLE)
    return found.select("file", "ordinal", "pmid", "version", "deleted", "doi", "title", "abstract", "journal_date", "revised", F.array_join("authors", "|").alias("authors"))


@query(f"""WITH {LINES}, p AS (SELECT doc_id, pdf_idx, replace(text, chr(13), '') AS text, (['Heading1', 'Normal', 'TOC1', 'cell', 'Title'])[1 + pdf_idx % 5] AS style FROM L)
SELECT doc_id, pdf_idx AS ordinal, CASE style WHEN 'TOC1' THEN 4 WHEN 'cell' THEN 5 WHEN 'Normal' THEN 0 ELSE 2 END AS cls, trim(text, ' \t') AS text FROM p""")
def docx_blocks(spark, d):
    """Office files in document order, contents before headings before tables before plain
    paragraphs. The files are written from documents."""
    styles = F.array(*map(F.lit, ("Heading1", "Normal", "TOC1", "cell", "Title")))
    p = lines_of(spark, d).select("doc_id", F.struct("pdf_idx", F.get(styles, F.col("pdf_idx") % 5).alias("style"), F.replace("text", F.lit("\r"), F.lit("")).alias("text")).alias("p"))
    p = p.groupBy("doc_id").agg(F.sort_array(F.collect_list("p")).alias("p"))

    @F.pandas_udf("binary")
    def written(x: pd.Series) -> pd.Series:
        return pd.Series([records.docx_file([(r["style"], r["text"]) for r in rows]) for rows in x])

    files = p.select("doc_id", written("p").alias("content"))
    return markup.parse(files, "doc_id", "content", markup.PARSERS["docx"]).drop("tag")


@query("""WITH r AS (SELECT o_custkey AS page, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders WHERE o_custkey % 4 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0)
SELECT page, i::INT - 1 AS ordinal, 'MD ' || k AS reference, 'Guide ' || k AS title, 'May ' || (2000 + k % 20) AS published, CASE WHEN k % 3 <> 0 THEN 'https://x.example/a/' || k || '.PDF' END AS pdf,
 CASE WHEN k % 5 = 0 THEN 'https://x.example/d' || k || '.doc' END AS docx FROM r""")
def guidance_list(spark, d):
    """Tables with the wanted headers, rows of three filled cells, the first link of each kind."""
    k = F.col("o_orderkey")
    s = k.cast("string")
    text = lambda *x: F.concat(*(F.lit(t) if isinstance(t, str) else t for t in x))
    links = text(F.when(k % 3 != 0, text('<a href="', s, '.PDF">a</a><a href="second.pdf">b</a>')).otherwise(""), F.when(k % 5 == 0, text('<a href=" /d', s, '.doc ">c</a>')).otherwise(""))
    # without the third cell, and with an empty title
    row = F.when(k % 7 == 0, text("<tr><td>MD ", s, "</td><td>short</td></tr>")).otherwise(text("<tr><td>MD ", s, "</td><td>", F.when(k % 11 == 0, " ").otherwise(text("Guide <b>", s, "</b>")), "</td><td>May ", (2000 + k % 20).cast("string"), "</td><td>", links, "</td></tr>"))
    pages = table(spark, d, "orders").select(F.col("o_custkey").alias("page"), F.struct(k, row.alias("row")).alias("r")).groupBy("page").agg(F.sort_array(F.collect_list("r")).alias("r"))
    head = F.when(F.col("page") % 4 == 0, "<tr><th>Reference</th><th>Date</th></tr>").otherwise("<tr><th>Reference</th><th> Title </th><th>Publication</th></tr>")
    pages = pages.select("page", text("<html><table>", head, F.array_join(F.transform("r", lambda r: r["row"]), "\n"), "</table></html>").alias("html"))
    return records.scan(pages, "page", "html", lambda x: records.guidance(x, "https://x.example/a/list.html"), records.GUIDANCE)


@query()
def notice_blocks(spark, d):
    """Headings, footnotes, classed paragraphs and tables of pages of notices, the first of equal texts."""
    return records.scan(_classed(spark, d), "doc_id", "html", records.notices, records.CLASSED)


@query()
def regulation_blocks(spark, d):
    """Paragraphs by their class, the last of a source line."""
    return records.scan(_classed(spark, d), "doc_id", "html", records.regulations, records.CLASSED)


def _classed(spark, d):
    """Pages written from documents: lines as paragraphs of several classes, headings and tables."""
    k = F.col("pdf_idx") % 7
    names = F.get(F.array(*map(F.lit, ("normal", "tbl-1", "footnote", "doc-title", "normal", "note"))), F.least(k, F.lit(5)))
    t = _escaped(F.col("text"))
    one = F.when(k == 6, F.concat(F.lit("<h2>"), t, F.lit("</h2><table><tr><td>x</td></tr></table>"))).otherwise(F.concat(F.lit('<p class="'), names, F.lit('">'), t, F.lit("</p>")))
    lines = lines_of(spark, d).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pdf_idx", one.alias("x")))).alias("x"))
    return lines.select("doc_id", F.concat(F.lit("<html><body>\n"), F.array_join(F.transform("x", lambda x: x["x"]), "\n"), F.lit("\n</body></html>")).alias("html"))
