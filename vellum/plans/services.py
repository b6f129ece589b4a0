"""Queries of the registry's services: lookups and changes of definitions, flags, new files, a page's batch, exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators import lifecycle
from vellum.plans.registry import query
from vellum.plans.registry_tables import _PAIR, _pair
from vellum.sources.storage import shared_path
from vellum.sources.tables import table

_DEFINITIONS = """d AS (SELECT p_partkey AS id, p_name AS term, p_type AS kind, p_brand AS category, 'source ' || p_size % 5 AS source, p_size % 2 = 0 AS approved, p_partkey % 3 AS vocabulary FROM part)"""


def _definitions(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("term"), F.col("p_type").alias("kind"), F.col("p_brand").alias("category"),
        F.concat(F.lit("source "), (F.col("p_size") % 5).cast("string")).alias("source"), (F.col("p_size") % 2 == 0).alias("approved"), (F.col("p_partkey") % 3).alias("vocabulary"),
    )


#: Lookups of definitions: by one column or several, each a filter that reaches the scan.
_LOOKUPS = {"id": {"id": 7}, "term": {"term": "cold widget"}, "kind": {"kind": "ECONOMY"}, "category": {"category": "Brand#13", "approved": True}, "source": {"source": "source 3"}, "approved": {"approved": True}, "vocabulary": {"vocabulary": 1, "kind": "ECONOMY"}}


@query(f"WITH {_DEFINITIONS} " + " UNION ALL ".join(f"SELECT '{k}' AS lookup, id, term FROM d WHERE " + " AND ".join(f"{c} = {v!r}" for c, v in w.items()) for k, w in _LOOKUPS.items()))
def definition_lookups(spark, d):
    """Definitions by id, term, type, category, source, approval and vocabulary."""
    found = [lifecycle.matching(_definitions(spark, d), **w).select(F.lit(k).alias("lookup"), "id", "term") for k, w in _LOOKUPS.items()]
    return reduce(DataFrame.unionAll, found)


@query(f"""WITH {_DEFINITIONS} SELECT id, CASE WHEN id % 10 = 1 THEN upper(term) ELSE term END AS term, approved OR id % 10 = 2 AS approved FROM d WHERE id % 10 <> 3
UNION ALL SELECT id + 1000000, 'new ' || term, false FROM d WHERE id % 50 = 0""")
def definition_changes(spark, d):
    """Definitions inserted, updated, approved and deleted in one pass over the table."""
    x = _definitions(spark, d).select("id", "term", "approved")
    k = F.col("id") % 10
    kept = x.where(k != 3).select("id", F.when(k == 1, F.upper("term")).otherwise(F.col("term")).alias("term"), (F.col("approved") | (k == 2)).alias("approved"))
    return kept.unionAll(x.where("id % 50 = 0").select(F.col("id") + 1_000_000, F.concat(F.lit("new "), F.col("term")), F.lit(False)))


@query("""SELECT 'script' AS lookup, o_orderkey AS id FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' UNION ALL SELECT 'url', c_custkey FROM customer WHERE c_custkey = 17
UNION ALL SELECT 'number', o_orderkey FROM orders WHERE 'K' || o_orderkey = 'K321' UNION ALL SELECT 'matched', o_orderkey FROM orders WHERE o_custkey = 85""")
def point_lookups(spark, d):
    """A script by its file name, a url by its id, a record by its number, the lines matched to one block."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    found = {
        "script": lifecycle.matching(o, o_orderpriority="3-MEDIUM", o_orderstatus="F").select(F.col("o_orderkey").alias("id")), "url": lifecycle.matching(c, c_custkey=17).select(F.col("c_custkey").alias("id")),
        "number": o.where(F.col("o_orderkey") == 321).select(F.col("o_orderkey").alias("id")), "matched": lifecycle.matching(o, o_custkey=85).select(F.col("o_orderkey").alias("id")),
    }
    return reduce(DataFrame.unionAll, (x.select(F.lit(k).alias("lookup"), "id") for k, x in found.items()))


@query("""WITH r AS (SELECT 'pubmed' || page_id || '.xml.gz' AS name, length(html) AS size FROM pages), l AS (SELECT 'pubmed' || page_id || '.xml.gz' AS name, length(html) + (page_id % 9 = 0)::INT AS size FROM pages WHERE page_id % 4 <> 0)
SELECT r.name, r.size::BIGINT AS size, CASE WHEN l.name IS NULL THEN 'new' ELSE 'size' END AS reason FROM r LEFT JOIN l USING (name) WHERE l.size IS DISTINCT FROM r.size""")
def new_files(spark, d):
    """Remote files that are not there or have another size than the local ones."""
    p = table(spark, d, "pages").select(F.concat(F.lit("pubmed"), F.col("page_id").cast("string"), F.lit(".xml.gz")).alias("name"), F.length("html").cast("long").alias("size"), "page_id")
    local = p.where("page_id % 4 != 0").select("name", (F.col("size") + (F.col("page_id") % 9 == 0).cast("int")).alias("local"))
    r = p.join(local, "name", "left").where(~F.col("local").eqNullSafe(F.col("size")))
    return r.select("name", "size", F.when(F.col("local").isNull(), "new").otherwise("size").alias("reason"))


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\r\\n\\f\\x0B]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id % 3 <> 1)
SELECT doc_id, doc_id % 3 <> 1 AS parsed, coalesce(ceil(len(w) / 128.0), 0)::BIGINT AS chunks, substr('log of ' || doc_id || ' ' || repeat('x', 5000), 1, 4095) AS log, doc_id % 2 = 0 AS embedded
FROM documents LEFT JOIN w USING (doc_id)""")
def parse_and_mark(spark, d):
    """Documents of the queue parsed and chunked, then marked; logs cut to their column's length."""
    docs = table(spark, d, "documents").select("doc_id", F.size(F.filter(F.split("text", r"[ \t\r\n\f\x0B]+"), lambda w: w != "")).alias("n"))
    parsed = F.col("doc_id") % 3 != 1
    log = F.substring(F.concat(F.lit("log of "), F.col("doc_id").cast("string"), F.lit(" "), F.repeat(F.lit("x"), 5000)), 1, 4095)
    chunks = F.when(parsed & (F.col("n") > 0), F.ceil(F.col("n") / 128)).otherwise(F.lit(0).cast("long"))
    return docs.select("doc_id", parsed.alias("parsed"), chunks.alias("chunks"), log.alias("log"), (F.col("doc_id") % 2 == 0).alias("embedded"))


@query(f"""WITH {_PAIR}, a AS (SELECT url, CASE WHEN reg.url IS NULL THEN 'insert' WHEN scr.url IS NULL THEN 'missing' WHEN NOT is_pdf THEN 'redownload' ELSE 'touch' END AS action FROM reg FULL JOIN scr USING (url)),
c AS (SELECT url FROM reg WHERE status = 1 AND seen < 20 AND NOT EXISTS (SELECT 1 FROM scr WHERE scr.url = reg.url))
SELECT action, count(*) AS n, count(c.url) AS cancelled FROM a LEFT JOIN c USING (url) GROUP BY 1""")
def page_batch(spark, d):
    """A page's batch: what is new, changed, touched and missing, and what of it is cancelled."""
    reg, scr = _pair(spark, d)
    cancelled = lifecycle.cancel_stale(reg, scr, before=20).select("url", F.lit(True).alias("gone"))
    return lifecycle.reconcile(reg, scr).join(cancelled, "url", "left").groupBy("action").agg(F.count("*").alias("n"), F.count("gone").alias("cancelled"))


@query("SELECT p_partkey AS id, p_name AS title, 'u' || p_partkey || '.pdf' AS pdf, CASE WHEN p_partkey % 2 = 0 THEN 'u' || p_partkey || '.docx' END AS docx FROM part")
def link_export(spark, d):
    """K9: nested links written as JSON, read again, and flattened for CSV, which is read again too."""
    s = F.col("p_partkey").cast("string")
    links = F.struct(F.concat(F.lit("u"), s, F.lit(".pdf")).alias("pdf"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("u"), s, F.lit(".docx"))).alias("docx"))
    at = shared_path(spark, "links")
    table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), links.alias("links")).write.json(f"{at}/json")
    nested = spark.read.schema("id long, title string, links struct<pdf: string, docx: string>").json(f"{at}/json")
    nested.select("id", "title", "links.pdf", "links.docx").write.option("header", True).csv(f"{at}/csv")
    return spark.read.schema("id long, title string, pdf string, docx string").option("header", True).csv(f"{at}/csv")
