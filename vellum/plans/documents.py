"""Queries of vector search, sections, parsing, alignment, models and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import text
from vellum.operators import align, models, sections, vectors
from vellum.plans.registry import query
from vellum.sources import markup
from vellum.sources.tables import LINES, line_table, lines_of, table
from vellum.streaming import ingest

# --- vectors --------------------------------------------------------------------------------------------------------

_DOT = "list_inner_product({0}::DOUBLE[], {1}::DOUBLE[])"


@query(f"""SELECT vec_id, list_aggregate(list_transform(embedding[1:4], lambda x: round(x / sqrt({_DOT.format("embedding", "embedding")}), 6)::VARCHAR), 'string_agg', ',') AS head,
 round(sqrt({_DOT.format("embedding", "embedding")}), 6) AS norm FROM embeddings""".replace("list_aggregate(list_transform(embedding[1:4], lambda x: round(x / sqrt(", "round(list_sum(list_transform(embedding[1:4], lambda x: x / sqrt(").replace("), 6)::VARCHAR), 'string_agg', ',') AS head", "))), 6) AS head"))  # fmt: skip
def vec_normalize(spark, d):
    """V1: rows divided by their length; the sum of the first four components, and the length."""
    e = F.col("embedding")
    n = vectors.normalised(e)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(F.slice(n, 1, 4), F.lit(0.0), lambda a, x: a + x), 6).alias("head"), F.round(F.sqrt(vectors.dot(e, e)), 6).alias("norm"))


_TOP = f"""s AS (SELECT q.vec_id AS query_id, e.vec_id, round({_DOT.format("q.embedding", "e.embedding")}, 6) AS score FROM embeddings e JOIN embeddings q ON q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id),
 t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)"""


@query(f"WITH {_TOP} SELECT query_id, vec_id, score, rank FROM t WHERE rank <= 10")
def vec_topk(spark, d):
    """V3, V5 (inner product): exact nearest rows of a bounded request."""
    e = table(spark, d, "embeddings")
    return vectors.search(e, e.where("vec_id % 100 = 0"))


@query(f"WITH {_TOP} SELECT vec_id, max(score) AS score, round(1 - (2 - 2 * max(score)) / 2, 6) AS shown FROM t WHERE rank <= 10 GROUP BY 1 ORDER BY score DESC, vec_id LIMIT 20")
def vec_fusion(spark, d):
    """V4, V5 (distance form): the best score of each id over all queries, cut to k."""
    return vectors.fused(vec_topk(spark, d), 20).withColumn("shown", F.round(1 - (2 - 2 * F.col("score")) / 2, 6))


@query("SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS label FROM embeddings WHERE vec_id % 11 <> 0")
def vec_upsert(spark, d):
    """Rows removed, added and replaced."""
    e = table(spark, d, "embeddings").select("vec_id", "label")
    new = e.where("vec_id % 7 = 0").withColumn("label", F.lit(-1))
    return vectors.remove(vectors.upsert(e, new), e.where("vec_id % 11 = 0"))


@query("SELECT vec_id, list_sum(list_transform(embedding, lambda x: greatest(-128, least(127, trunc(x * 128)::INT))))::BIGINT AS code_sum FROM embeddings")
def vec_quantize(spark, d):
    """Components as bytes, cut at the range's ends."""
    return table(spark, d, "embeddings").select("vec_id", F.aggregate(vectors.int8(F.col("embedding")), F.lit(0).cast("long"), lambda a, x: a + x).alias("code_sum"))


@query()
def ivf_topk(spark, d):
    """K-means lists built in one scan, some of them read for each query."""
    e = table(spark, d, "embeddings")
    return vectors.InvertedLists(e).search(e.where("vec_id % 100 = 0"))


@query()
def pq_codes(spark, d):
    """V2: product quantisation."""
    return vectors.product_codes(table(spark, d, "embeddings"), parts=4, codes=8)


@query()
def pq_topk(spark, d):
    """V2: search by tables of product codes, candidates ranked exactly."""
    e = table(spark, d, "embeddings")
    return vectors.ProductIndex(e).search(e.where("vec_id % 100 = 0"))


@query()
def ivfpq_topk(spark, d):
    """V2: product codes within inverted lists."""
    e = table(spark, d, "embeddings")
    return vectors.InvertedProductIndex(e).search(e.where("vec_id % 100 = 0"))


@query()
def graph_topk(spark, d):
    """V2: layered neighbour graphs over blocks of rows."""
    e = table(spark, d, "embeddings")
    return vectors.GraphIndex(e).search(e.where("vec_id % 100 = 0"))


@query("SELECT count(*) AS rows, true AS small FROM embeddings")
def reindex_chunks(spark, d):
    """V9: rows of a reindex in parts of at most 25,000; all rows, and whether each part is small enough."""
    sizes = vectors.chunks(table(spark, d, "embeddings").select("vec_id")).groupBy("chunk").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("rows"), (F.max("n") <= 25_000).alias("small"))


# --- sections -------------------------------------------------------------------------------------------------------

_SECTIONS = f"""{LINES}, r AS (SELECT *, predicted = 4 AS toc, max(CASE WHEN predicted = 4 AND page > 0.1 * mp THEN pdf_idx END) OVER (PARTITION BY doc_id) AS rs FROM (SELECT *, max(page) OVER (PARTITION BY doc_id) AS mp FROM L)),
 k AS (SELECT *, predicted IN (2, 3) AS head FROM r WHERE rs IS NULL OR pdf_idx > rs),
 b AS (SELECT *, lag(CASE WHEN head THEN 1 WHEN toc THEN 2 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pdf_idx) AS bf FROM k),
 st AS (SELECT *, ((head AND NOT coalesce(bf = 1, false)) OR (coalesce(bf = 2, false) AND NOT head))::INT AS st FROM b),
 sec AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING)::INT AS section FROM st),
 sections AS (SELECT doc_id, section, coalesce(string_agg(text, ' - ' ORDER BY pdf_idx) FILTER (head), 'Introduction') AS heading, coalesce(string_agg(text, ' ' ORDER BY pdf_idx) FILTER (NOT head), '') AS content, count(*) AS n_lines FROM sec WHERE NOT toc GROUP BY 1, 2)"""


@query(f"WITH {_SECTIONS} SELECT * FROM sections")
def doc_sections(spark, d):
    """M1, M6: lines to sections."""
    return sections.sections(lines_of(spark, d))


@query(f"""WITH {_SECTIONS}, e AS (SELECT *, (contains(lower(heading), 'executive summary') OR contains(lower(heading), 'abstract') OR contains(lower(heading), 'key takeaways')) AS ex FROM sections),
 a AS (SELECT *, max(ex::INT) OVER (PARTITION BY doc_id) AS any_ex FROM e)
SELECT doc_id, section, heading, content, n_lines FROM a WHERE (ex OR any_ex = 0) AND NOT regexp_matches(lower(heading), 'glossary|acronyms|definitions|references|abbreviations') AND length(content) >= length(heading)""")
def valid_sections(spark, d):
    """M2, M3: executive sections only where there are any, no glossaries."""
    return sections.wanted(sections.sections(lines_of(spark, d)))


@query()
def section_chunks(spark, d):
    """M4: sections packed up to a budget of words."""
    return sections.chunks(sections.wanted(sections.sections(lines_of(spark, d))))


@query()
def section_summary(spark, d):
    """M5: an extractive stand-in for the summary."""
    return sections.extractive_summary(sections.wanted(sections.sections(lines_of(spark, d))))


# --- parsing --------------------------------------------------------------------------------------------------------


@query()
def html_blocks(spark, d):
    """Blocks of web pages, the first of equal ones."""
    return markup.first_of_equal(markup.parse(table(spark, d, "pages"), "page_id", "html", markup.PARSERS["html"]), "page_id")


@query(r"""WITH l AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
t AS (SELECT doc_id, i, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS text FROM l)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i)::INT - 1 AS ordinal, CASE WHEN i % 4 = 0 THEN 'HD' ELSE 'P' END AS tag, CASE WHEN i % 4 = 0 THEN 2 ELSE 0 END AS cls, text FROM t WHERE text <> ''""")
def xml_blocks(spark, d):
    """S5, S5b, S5c, S5g, S6, S6c, S11: tag-dispatched blocks of regulation markup made from documents."""
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.array_join(F.transform(F.split(esc, "\n"), lambda x, i: F.concat(F.when(i % 4 == 0, "<HD>").otherwise("<P>"), x, F.when(i % 4 == 0, "</HD>").otherwise("</P>"))), "")
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("<PART><SECTION>"), body, F.lit("</SECTION></PART>")).alias("xml"))
    return markup.parse(docs, "doc_id", "xml", markup.PARSERS["xml"])


@query()
def latex_blocks(spark, d):
    """S7, S7a to S7e, T29: sections, items and paragraphs of LaTeX made from documents."""
    body = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 5 == 0, F.concat(F.lit("\\section{"), x, F.lit("}"))).when(i % 5 == 3, F.concat(F.lit("\\item \\textbf{"), x, F.lit("}"))).otherwise(x)), "\n\n")
    return markup.parse(table(spark, d, "documents").select("doc_id", body.alias("tex")), "doc_id", "tex", markup.PARSERS["latex"])


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '<[^>]*>?', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages""")
def html_text(spark, d):
    """Text of pages without scripts and comments, as a column."""
    return table(spark, d, "pages").select("page_id", markup.plain_html(F.col("html")).alias("plain"))


# --- alignment ------------------------------------------------------------------------------------------------------


@query()
def align_lines(spark, d):
    """Lines of one version aligned with the blocks of another: windows of lines
    in windows of blocks, then lines in the blocks around, with used ranges and classes of continuations."""
    # documents are dealt before they are cut, to as many tasks as there are, however small they are
    all_lines = line_table(table(spark, d, "documents").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id"))
    lines = all_lines.select("doc_id", "pdf_idx", F.col("text").alias("raw"), text.clean_text(F.col("text")).alias("text")).where("text != ''")
    blocks = all_lines.withColumn("xml_idx", F.expr("cast(pdf_idx div 3 as int)"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pdf_idx", "text"))), lambda x: x["text"]), " ")
    cls = F.min_by(F.when(F.col("predicted").isin(2, 3), 2).otherwise(0), "pdf_idx")
    blocks = blocks.groupBy("doc_id", "xml_idx").agg(text.clean_text(F.replace(joined, F.lit("tion"), F.lit("shun"))).alias("text"), cls.alias("cls")).where("text != ''")
    return align.align(lines, blocks)


@query()
def partial_ratio_join(spark, d):
    """The last turn of the other version of a conversation that a turn matches well enough."""
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("pdf_idx"), text.clean_text(F.col("text")).alias("text"))
    items = turns.select("doc_id", F.col("pdf_idx").alias("item_id"), F.replace("text", F.lit("tion"), F.lit("shun")).alias("item"))
    return align.partial_join(turns, items)


@query()
def header_footnotes(spark, d):
    """Margins from tolerant modes of page-edge gaps."""
    return align.margins(lines_of(spark, d))


@query()
def mojibake(spark, d):
    """S1h: text read in the wrong encoding repaired."""
    broken = F.replace(F.replace("text", F.lit("é"), F.lit("Ã©")), F.lit("ü"), F.lit("Ã¼"))
    return table(spark, d, "documents").select("doc_id", align.repair_encoding(broken).alias("repaired"))


# --- models and streams ---------------------------------------------------------------------------------------------


@query()
def rf_predict(spark, d):
    """ML1, ML4 to ML7, ML15, ML18, F27, L10: a forest over line features, classes with probabilities."""
    return models.forest_predictions(lines_of(spark, d))


@query()
def boosted_predict(spark, d):
    """ML2: boosted trees, one class against the others, over the same features."""
    return models.boosted_predictions(lines_of(spark, d))


@query()
def feature_importance(spark, d):
    """G14, ML11 (stand-in): importances of a forest with their running share."""
    return models.importances(lines_of(spark, d))


@query("""WITH e AS (SELECT epoch(date_trunc('hour', ts))::BIGINT AS start, event_type, count(*) AS n, sum(round(value * 10000)::BIGINT)::DOUBLE / 10000 AS total, max(max(ts)) OVER () AS latest FROM events GROUP BY 1, 2)
SELECT start, event_type, n, total FROM e WHERE start + 3600 <= epoch(latest) - 3600""")
def stream_windows(spark, d):
    """Extension: events as a stream, counts by window with a watermark."""
    return ingest.window_counts(spark, d)


@query("""SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, count(*) AS n FROM events GROUP BY 1""")
def stream_upsert(spark, d):
    """D7, K2, K3, K10 as a stream: the last state of each key, batch by batch."""
    return ingest.last_states(spark, d)
