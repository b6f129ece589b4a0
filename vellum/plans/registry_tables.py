"""Queries of document registries: reconciliation, updates, deletes, logs, exports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.operators import lifecycle
from vellum.plans.registry import query
from vellum.sources.tables import table

_URL = "regexp_replace(url, '[?#].*$', '')"
_PAIR = f"""reg AS (SELECT {_URL} AS url, min(page_id) AS doc, max(page_id % 3)::INT AS status, min(page_id % 28)::INT + 1 AS seen FROM pages WHERE page_id % 4 <> 3 GROUP BY 1),
 scr AS (SELECT {_URL} AS url, min(page_id) AS doc, bool_and(page_id % 5 <> 0) AS is_pdf FROM pages WHERE page_id % 4 <> 0 GROUP BY 1)"""


def _pair(spark, d):
    p = table(spark, d, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"))
    reg = p.where("page_id % 4 != 3").groupBy("url").agg(F.min("page_id").alias("doc"), F.max(F.col("page_id") % 3).cast("int").alias("status"), (F.min(F.col("page_id") % 28).cast("int") + 1).alias("seen"))
    scr = p.where("page_id % 4 != 0").groupBy("url").agg(F.min("page_id").alias("doc"), F.bool_and(F.col("page_id") % 5 != 0).alias("is_pdf"))
    return reg, scr


@query(f"""WITH {_PAIR} SELECT url, CASE WHEN reg.url IS NULL THEN 'insert' WHEN scr.url IS NULL THEN 'missing' WHEN NOT is_pdf THEN 'redownload' ELSE 'touch' END AS action, coalesce(reg.doc, scr.doc) AS doc FROM reg FULL JOIN scr USING (url)""")
def reconcile_scrape(spark, d):
    """What a scrape means for the registry."""
    reg, scr = _pair(spark, d)
    return lifecycle.reconcile(reg, scr)


@query(f"""WITH {_PAIR} SELECT url, doc, 2 AS status FROM reg WHERE status = 1 AND seen < 20 AND NOT EXISTS (SELECT 1 FROM scr WHERE scr.url = reg.url)""")
def cancel_stale(spark, d):
    """Active documents not seen lately and not reachable."""
    reg, scr = _pair(spark, d)
    return lifecycle.cancel_stale(reg, scr, before=20)


@query(f"""WITH {_PAIR} SELECT reg.url, reg.doc, 3 AS status FROM reg JOIN (SELECT url FROM scr WHERE doc % 7 = 0) l USING (url)""")
def cancel_by_list(spark, d):
    """Documents on a published list."""
    reg, scr = _pair(spark, d)
    return reg.join(scr.where("doc % 7 = 0").select("url"), "url").select("url", "doc", F.lit(3).alias("status"))


@query("""WITH e AS (SELECT o_custkey AS title, year(o_orderdate)::INT AS y, max(o_orderkey) AS doc FROM orders GROUP BY 1, 2), c AS (SELECT title, max(y) AS cur FROM e GROUP BY 1)
SELECT e.title, max(y) AS cancelled_year, arg_max(doc, y) AS doc FROM e JOIN c USING (title) WHERE y < cur AND y > cur - 4 GROUP BY 1""")
def cancel_editions(spark, d):
    """The latest earlier edition within a range of years."""
    e = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("title"), F.year("o_orderdate").alias("y")).agg(F.max("o_orderkey").alias("doc"))
    cur = F.max("y").over(Window.partitionBy("title"))
    return e.withColumn("cur", cur).where("y < cur and y > cur - 4").groupBy("title").agg(F.max("y").alias("cancelled_year"), F.max_by("doc", "y").alias("doc"))


@query("""WITH v AS (SELECT user_id AS pmid, (event_id % 5)::INT AS version, event_id, event_type AS body, event_type = 'error' AS deleted FROM events), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY version DESC, event_id DESC) AS r FROM v) WHERE r = 1),
s AS (SELECT c_custkey AS pmid, 2 AS stored_version, 'view' AS stored_body FROM customer WHERE c_custkey % 2 = 0)
SELECT pmid, version, CASE WHEN deleted THEN 'delete' WHEN stored_version IS NULL THEN 'insert' WHEN version > stored_version THEN 'update' WHEN version = stored_version AND body <> stored_body THEN 'update_text' ELSE 'keep' END AS action FROM l LEFT JOIN s USING (pmid)""")
def version_upsert(spark, d):
    """The newest version of each article against what is stored."""
    v = table(spark, d, "events").select(F.col("user_id").alias("pmid"), (F.col("event_id") % 5).cast("int").alias("version"), "event_id", F.col("event_type").alias("body"))
    s = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("pmid"), F.lit(2).alias("stored_version"), F.lit("view").alias("stored_body"))
    return lifecycle.version_actions(v, s)


@query("""SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '1998-12-31')::INT AS age, o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'O' AS stale FROM orders""")
def staleness(spark, d):
    """Age in days, and the staleness filter."""
    o = table(spark, d, "orders")
    stale = (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderstatus") == "O")
    return o.select("o_orderkey", F.datediff(F.lit("1998-12-31").cast("date"), F.col("o_orderdate").cast("date")).alias("age"), stale.alias("stale"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' ORDER BY o_orderkey LIMIT 100")
def parse_queue(spark, d):
    """The next documents to work on (a limit is the feature)."""
    return table(spark, d, "orders").where("o_orderstatus = 'O' and o_orderpriority != '5-LOW'").select("o_orderkey", "o_orderdate").orderBy("o_orderkey").limit(100)


@query("SELECT count(*) AS waiting, max(o_orderkey) AS last_order, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_orderstatus = 'O'")
def queue_size(spark, d):
    """Counts and the highest order number."""
    return table(spark, d, "orders").where("o_orderstatus = 'O'").agg(F.count("*").alias("waiting"), F.max("o_orderkey").alias("last_order"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'UPDATED' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS parsed FROM customer WHERE c_custkey % 13 <> 0")
def apply_changes(spark, d):
    """Updates by key and deletes by key, copy on write."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.lit(0).alias("parsed"))
    new = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("UPDATED").alias("c_mktsegment"), F.lit(1).alias("parsed"))
    gone = c.where("c_custkey % 13 = 0").select("c_custkey")
    return lifecycle.delete(lifecycle.update(c, new, "c_custkey"), gone, "c_custkey")


@query("""SELECT user_id, string_agg(coalesce(event_type, ''), chr(10) ORDER BY event_id) || chr(10) AS log, length(substr(string_agg(event_type, chr(10) ORDER BY event_id), 1, 4095))::INT AS cut FROM events GROUP BY 1""")
def log_append(spark, d):
    """K8, K6: messages appended in order, a log cut to its column."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", F.coalesce("event_type", F.lit("")).alias("m")))), lambda x: x["m"]), "\n")
    g = table(spark, d, "events").groupBy("user_id").agg(joined.alias("j"))
    return g.select("user_id", F.concat("j", F.lit("\n")).alias("log"), F.length(F.substring("j", 1, 4095)).alias("cut"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events""")
def flatten_links(spark, d):
    """K9: nested values flattened."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("")).alias("missing"))


@query("""WITH n AS (SELECT DISTINCT r_name || '>' || n_name AS arch, r_name FROM nation JOIN region ON n_regionkey = r_regionkey), a AS (SELECT arch FROM n UNION SELECT r_name FROM n)
SELECT arch AS node, CASE WHEN contains(arch, '>') THEN regexp_replace(arch, '>[^>]*$', '') END AS parent FROM a""")
def graph_export(spark, d):
    """Nodes and parent edges of an architecture path."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    arch = n.select(F.concat_ws(">", "r_name", "n_name").alias("node")).union(n.select("r_name")).distinct()
    return arch.select("node", F.when(F.contains("node", F.lit(">")), F.regexp_replace("node", ">[^>]*$", "")).alias("parent"))


@query("SELECT page_id, md5(html) AS digest, (strlen(html) + 3) // 1000 AS kilobytes, floor((page_id - 1) / 10.0)::BIGINT AS batch FROM pages")
def md5_and_batches(spark, d):
    """Content digests and batches."""
    return table(spark, d, "pages").select("page_id", F.md5(F.col("html").cast("binary")).alias("digest"), F.expr("(octet_length(html) + 3L) div 1000").alias("kilobytes"), F.expr("floor((page_id - 1) / 10)").cast("long").alias("batch"))


@query("""WITH p AS (SELECT o_custkey AS doc FROM orders WHERE o_orderkey % 3 = 0) SELECT DISTINCT c_custkey AS doc, (EXISTS (SELECT 1 FROM p WHERE p.doc = c_custkey)) AS existed FROM customer""")
def ensure_parent(spark, d):
    """Parents that exist, and those to insert."""
    have = table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("doc"), F.lit(True).alias("existed")).distinct()
    want = table(spark, d, "customer").select(F.col("c_custkey").alias("doc")).distinct()
    return want.join(have, "doc", "left").select("doc", F.coalesce("existed", F.lit(False)).alias("existed"))


@query("""WITH k AS (SELECT doc_id, lang AS label, count(*) AS n FROM documents GROUP BY 1, 2) SELECT doc_id, max(n) FILTER (label = 'en') AS en, max(n) FILTER (label = 'fr') AS fr FROM k GROUP BY 1""")
def label_pivot(spark, d):
    """Label and value pairs to one record."""
    return table(spark, d, "documents").groupBy("doc_id").pivot("lang", ["en", "fr"]).agg(F.count(F.lit(1)))


@query(r"""WITH r AS (SELECT page_id, string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages) SELECT page_id, len(parts)::INT AS n_parts, CASE WHEN len(parts) > 2 THEN parts[3] ELSE parts[2] END AS title, parts[1] AS site FROM r""")
def listing_rows(spark, d):
    """Rows of a listing by their number of parts."""
    parts = F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/")
    return table(spark, d, "pages").select("page_id", F.size(parts).alias("n_parts"), F.when(F.size(parts) > 2, F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1))).alias("title"), F.get(parts, F.lit(0)).alias("site"))


@query("SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN 'draft' WHEN source IN ('src2', 'src3') THEN 'private' ELSE 'public' END AS repo FROM documents")
def repositories(spark, d):
    """The repository of a document, by SQL text."""
    docs = table(spark, d, "documents")
    return spark.sql("select doc_id, case when source in ('src0', 'src1') then 'draft' when source in ('src2', 'src3') then 'private' else 'public' end as repo from {docs}", docs=docs)
