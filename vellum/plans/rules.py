"""Queries of smaller rules: crops, filters, bins around a mode, older repair rules, listings, dates, text checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum import schema
from vellum.operators import sequence
from vellum.plans.registry import query
from vellum.sources.tables import LINES, lines_of, table

# --- crops and filters ----------------------------------------------------------------------------------------------

# Insets of a page's crop by the kind of file (left, right, top, bottom); None: that edge of the page;
# a negative number counts from the far edge. Kinds not listed keep the whole page.
CROPS = {"CFR": (60, -60, 60, -60), "FAA_Advisory_Circulars_Data": (20, 530, 30, 680), "Arxiv": (0, None, 0, None)}
_KINDS = ("CFR", "FAA_Advisory_Circulars_Data", "Arxiv", "Other")


@query(f"""WITH k AS (SELECT doc_id, ({list(_KINDS)})[1 + doc_id % 4] AS kind, 600 + doc_id % 13 AS width, 780 + doc_id % 11 AS height FROM documents)
SELECT doc_id, kind, CASE kind WHEN 'CFR' THEN 60 WHEN 'FAA_Advisory_Circulars_Data' THEN 20 ELSE 0 END::BIGINT AS x0, CASE kind WHEN 'CFR' THEN width - 60 WHEN 'FAA_Advisory_Circulars_Data' THEN 530 ELSE width END::BIGINT AS x1,
 CASE kind WHEN 'CFR' THEN 60 WHEN 'FAA_Advisory_Circulars_Data' THEN 30 ELSE 0 END::BIGINT AS y0, CASE kind WHEN 'CFR' THEN height - 60 WHEN 'FAA_Advisory_Circulars_Data' THEN 680 ELSE height END::BIGINT AS y1 FROM k""")
def crop_bounds(spark, d):
    """The crop of a page by the kind of its file, the whole page by default."""
    kind = F.get(F.array(*map(F.lit, _KINDS)), (F.col("doc_id") % 4).cast("int"))
    pages = table(spark, d, "documents").select("doc_id", kind.alias("kind"), (600 + F.col("doc_id") % 13).alias("width"), (780 + F.col("doc_id") % 11).alias("height"))

    def edge(i: int, size: str):
        of = schema.lookup(F.col("kind"), {k: v[i] for k, v in CROPS.items() if v[i] is not None}).cast("long")
        far = F.when(of < 0, F.col(size) + of).otherwise(of)
        return F.coalesce(far, F.lit(0).cast("long") if i in (0, 2) else F.col(size).cast("long"))

    return pages.select("doc_id", "kind", *(edge(i, s).alias(n) for i, (n, s) in enumerate((("x0", "width"), ("x1", "width"), ("y0", "height"), ("y1", "height")))))


# Starts and characters of texts that are no prose.
NO_PROSE_STARTS, NO_PROSE = ("[Reg", "[T"), r"\!@#$%^&*"


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, NOT (starts_with(text, '[Reg') OR starts_with(text, '[T') OR regexp_matches(text, '[\\\\!@#$%^&*]')) AS is_prose FROM L")
def prose_filter(spark, d):
    """Texts with field marks or symbols are no prose; a model of nonsense words is out of scope."""
    t = F.col("text")
    starts = t.startswith(NO_PROSE_STARTS[0]) | t.startswith(NO_PROSE_STARTS[1])
    return lines_of(spark, d).select("doc_id", "pdf_idx", (~(starts | t.rlike("[" + NO_PROSE.replace("\\", "\\\\").replace("^", "\\^") + "]"))).alias("is_prose"))


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, labelled, font_size, ncols, page FROM L")
def required_columns(spark, d):
    """A feature added, required columns checked on the schema alone, the class column first."""
    lines = lines_of(spark, d).withColumn("added", F.col("font_size"))
    wanted = ("font_size", "ncols", "page", "added")
    known = schema.require(lines, ("labelled", *wanted))
    return known.select("doc_id", "pdf_idx", "labelled", *wanted).drop("added")


# --- bins around the mode -------------------------------------------------------------------------------------------

# Edges in deviations from the mode; the share that is trimmed at each end.
MODE_EDGES, TRIM = (-2.0, -1.0, -0.5, -0.125, 0.125, 0.5, 1.0, 2.0), 0.01


@query(f"""WITH r AS (SELECT l_returnflag AS g, l_quantity::DOUBLE AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
t AS (SELECT * FROM r WHERE i >= floor(0.01 * n) AND i < floor(n - 0.01 * n)), c AS (SELECT g, v, count(*) AS c FROM t GROUP BY 1, 2),
m AS (SELECT g, arg_min(v, -c * 1000000 + v) AS m FROM c GROUP BY 1), s AS (SELECT g, stddev_pop(v) AS s FROM t GROUP BY 1)
SELECT g AS l_returnflag, v AS l_quantity, ({" + ".join(f"(v >= m + ({e}) * s)::INT" for e in MODE_EDGES)} + 1)::INT AS bin, count(*) AS n FROM r JOIN m USING (g) JOIN s USING (g) GROUP BY 1, 2, 3""")
def mode_bins(spark, d):
    """nine half-open bins around the mode of the values left after a trim, by their deviation. All is computed
    from counts of values, so no sort holds the rows of a group."""
    values = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("g"), F.col("l_quantity").cast("double").alias("v")).agg(F.count("*").alias("c"))
    by = Window.partitionBy("g")
    values = values.withColumns({"upto": F.sum("c").over(by.orderBy("v")), "n": F.sum("c").over(by)})
    lo, hi = F.floor(F.col("n") * TRIM), F.floor(F.col("n") - F.col("n") * TRIM)
    kept = F.greatest(F.lit(0), F.least(F.col("upto"), hi) - F.greatest(F.col("upto") - F.col("c"), lo))
    values = values.withColumn("k", kept)
    mean = F.sum(F.col("k") * F.col("v")).over(by) / F.sum("k").over(by)
    values = values.withColumns({"mean": mean, "top": F.max(F.struct("k", -F.col("v"))).over(by)})
    spread = F.sqrt(F.sum(F.col("k") * (F.col("v") - F.col("mean")) ** 2).over(by) / F.sum("k").over(by))
    values = values.withColumns({"s": spread, "m": -F.col("top.col2")})
    code = sum(((F.col("v") >= F.col("m") + e * F.col("s")).cast("int") for e in MODE_EDGES), F.lit(1))
    return values.select(F.col("g").alias("l_returnflag"), F.col("v").alias("l_quantity"), code.alias("bin"), F.col("c").alias("n"))


# --- older repair rules ---------------------------------------------------------------------------------------------

_OLDER = f"""WITH RECURSIVE {LINES.replace("L AS", "L AS", 1)},
z AS (SELECT doc_id, pdf_idx, CASE WHEN contains(text, '.....') THEN 4 ELSE predicted END AS c, count(*) OVER (PARTITION BY doc_id) AS n FROM L),
q AS (SELECT *, lead(c) OVER (PARTITION BY doc_id ORDER BY pdf_idx) AS nx FROM z),
f AS (SELECT doc_id, pdf_idx, n, CASE WHEN c = 3 THEN 2 ELSE c END AS cls FROM q WHERE pdf_idx = 0
 UNION ALL SELECT doc_id, pdf_idx, n, CASE WHEN p = 1 THEN CASE WHEN nx = 1 THEN 0 WHEN nx = 0 THEN 3 ELSE c2 END ELSE c2 END FROM (
  SELECT q.doc_id, q.pdf_idx, q.n, q.nx,
   CASE WHEN q.pdf_idx = q.n - 1 THEN CASE WHEN f.cls NOT IN (2, 3) AND q.c = 3 THEN 2 ELSE q.c END
    WHEN f.cls NOT IN (2, 3) AND q.c = 3 THEN 2 WHEN f.cls = 4 AND q.nx = 4 AND q.c <> 2 THEN 4 ELSE q.c END AS c2,
   (q.pdf_idx < q.n - 1 AND f.cls IN (2, 3) AND q.c = 1)::INT AS p
  FROM f JOIN q ON q.doc_id = f.doc_id AND q.pdf_idx = f.pdf_idx + 1))
SELECT doc_id, pdf_idx, cls::INT AS cls FROM f"""


@query(_OLDER)
def older_rules(spark, d):
    """The older list of rules, which reads the class before as it has just been set: one pass a document."""
    lines = lines_of(spark, d).select("doc_id", "pdf_idx", F.when(F.contains("text", F.lit(".....")), 4).otherwise(F.col("predicted")).alias("cls"))
    return sequence.older_rules(lines)


# --- editions, listings, dates --------------------------------------------------------------------------------------

# Titles and volumes of the editions that are looked for, and the form of their addresses.
EDITIONS = tuple((14, v) for v in range(1, 6)) + ((21, 8),)
EDITION_URL = "https://www.govinfo.gov/content/pkg/CFR-%1$s-title%2$s-vol%3$s/%4$s/CFR-%1$s-title%2$s-vol%3$s-chapI-subchapH.%4$s"


@query("""WITH y AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders), e(title, volume) AS (VALUES (14, 1), (14, 2), (14, 3), (14, 4), (14, 5), (21, 8)), k(kind) AS (VALUES ('xml'), ('pdf')),
p AS (SELECT year, title, volume, kind, 'CFR-' || year || '-title' || title || '-vol' || volume AS s FROM y, e, k)
SELECT year::INT AS year, title, volume, kind, 'https://www.govinfo.gov/content/pkg/' || s || '/' || kind || '/' || s || '-chapI-subchapH.' || kind AS url,
 year = max(year) OVER (PARTITION BY title, volume, kind) AS latest FROM p""")
def edition_urls(spark, d):
    """The addresses of all editions of the listed titles and volumes; the latest year of each."""
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    editions = F.array(*(F.struct(F.lit(t).alias("title"), F.lit(v).alias("volume")) for t, v in EDITIONS))
    p = years.withColumn("e", F.explode(editions)).withColumn("kind", F.explode(F.array(F.lit("xml"), F.lit("pdf")))).select("year", "e.title", "e.volume", "kind")
    latest = F.col("year") == F.max("year").over(Window.partitionBy("title", "volume", "kind"))
    return p.select("year", "title", "volume", "kind", F.format_string(EDITION_URL, *(F.col(c).cast("string") for c in ("year", "title", "volume", "kind"))).alias("url"), latest.alias("latest"))


# Names of months in records of articles.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


@query(f"""WITH e AS (SELECT o_orderkey, year(o_orderdate) AS y, CASE o_orderkey % 6 WHEN 0 THEN month(o_orderdate)::VARCHAR WHEN 1 THEN strftime(o_orderdate, '%b') WHEN 2 THEN ' ' || upper(strftime(o_orderdate, '%b')) || ' '
  WHEN 3 THEN strftime(o_orderdate, '%B') WHEN 4 THEN 'Winter' END AS month_text, CASE o_orderkey % 4 WHEN 0 THEN day(o_orderdate)::VARCHAR WHEN 1 THEN '1-7' WHEN 2 THEN ' ' || (1 + day(o_orderdate) % 28) END AS day_text FROM orders)
SELECT o_orderkey, month_text, day_text, make_date(y, coalesce(try_cast(trim(month_text) AS INT), nullif(list_position({list(MONTHS)}, lower(trim(month_text))), 0), 1)::BIGINT, coalesce(try_cast(trim(day_text) AS INT), 1)::BIGINT) AS day FROM e""")
def lenient_dates(spark, d):
    """Month as a number or a short name, else 1; day as a number, else 1."""
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    short = F.date_format(o, "MMM")
    month = F.when(k % 6 == 0, F.month(o).cast("string")).when(k % 6 == 1, short).when(k % 6 == 2, F.concat(F.lit(" "), F.upper(short), F.lit(" "))).when(k % 6 == 3, F.date_format(o, "MMMM")).when(k % 6 == 4, "Winter")
    day = F.when(k % 4 == 0, F.day(o).cast("string")).when(k % 4 == 1, "1-7").when(k % 4 == 2, F.concat(F.lit(" "), (1 + F.day(o) % 28).cast("string")))
    e = table(spark, d, "orders").select("o_orderkey", F.year(o).alias("y"), month.alias("month_text"), day.alias("day_text"))
    number = F.coalesce(F.trim("month_text").try_cast("int"), schema.lookup(F.lower(F.trim("month_text")), {m: i + 1 for i, m in enumerate(MONTHS)}), F.lit(1))
    return e.select("o_orderkey", "month_text", "day_text", F.make_date("y", number, F.coalesce(F.trim("day_text").try_cast("int"), F.lit(1))).alias("day"))


@query("""WITH e AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'DEN' ELSE 'K' END || o_orderkey AS number, CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS received FROM orders)
SELECT number, received, try_strptime(received, '%m/%d/%Y')::DATE AS day FROM e WHERE NOT starts_with(number, 'D')""")
def device_records(spark, d):
    """Records whose number begins with D are skipped; dates as month/day/year, null for others."""
    k = F.col("o_orderkey")
    e = table(spark, d, "orders").select(F.concat(F.when(k % 5 == 0, "DEN").otherwise("K"), k.cast("string")).alias("number"), F.when(k % 7 == 0, "unknown").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("received"))
    return e.where(~F.col("number").startswith("D")).select("number", "received", F.try_to_date("received", "MM/dd/yyyy").alias("day"))


_LISTING = """e AS (SELECT o_custkey AS page, o_orderkey AS row, year(o_orderdate) AS y, CASE o_orderkey % 4 WHEN 0 THEN 'T' || o_orderkey || '|' || strftime(o_orderdate, '%d %B %Y') || '|PDF|about ' || o_orderkey
  WHEN 1 THEN 'T' || o_orderkey || '|' || strftime(o_orderdate, '%d %B %Y') || '|PDF' WHEN 2 THEN 'T' || o_orderkey || '|a description|PDF' ELSE 'T' || o_orderkey END AS t FROM orders),
p AS (SELECT *, string_split(t, '|') AS a, try_strptime(string_split(t, '|')[2], '%d %B %Y')::DATE AS d2 FROM e)"""


@query(f"""WITH {_LISTING} SELECT page, row, a[1] AS title, CASE len(a) WHEN 4 THEN d2 WHEN 3 THEN coalesce(d2, make_date(y, 1, 1)) ELSE make_date(y, 1, 1) END AS day,
 CASE WHEN len(a) = 4 THEN a[4] WHEN len(a) = 3 AND d2 IS NULL THEN a[2] END AS description FROM p""")
def listing_by_parts(spark, d):
    """A listing's row by the number of its parts: title, date and description, or one of these, or the title."""
    e = _listing(table(spark, d, "orders"))
    first = F.make_date("y", F.lit(1), F.lit(1))
    n = F.size("a")
    day = F.when(n == 4, F.col("d2")).when(n == 3, F.coalesce("d2", first)).otherwise(first)
    description = F.when(n == 4, F.get("a", F.lit(3))).when((n == 3) & F.col("d2").isNull(), F.get("a", F.lit(1)))
    return e.select("page", "row", F.get("a", F.lit(0)).alias("title"), day.alias("day"), description.alias("description"))


def _listing(orders):
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    title, day = F.concat(F.lit("T"), k.cast("string")), F.date_format(o, "dd MMMM yyyy")
    text = F.when(k % 4 == 0, F.concat_ws("|", title, day, F.lit("PDF"), F.concat(F.lit("about "), k.cast("string")))).when(k % 4 == 1, F.concat_ws("|", title, day, F.lit("PDF")))
    text = text.when(k % 4 == 2, F.concat(title, F.lit("|a description|PDF"))).otherwise(title)
    e = orders.select(F.col("o_custkey").alias("page"), k.alias("row"), F.year(o).alias("y"), F.split(text, r"\|").alias("a"))
    return e.withColumn("d2", F.try_to_date(F.get("a", F.lit(1)), "dd MMMM yyyy"))


@query(f"""WITH {_LISTING}, r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY row DESC) AS back, lead(row) OVER (PARTITION BY page ORDER BY row) AS after, count(*) OVER (PARTITION BY page) AS n FROM p)
SELECT page, row, CASE WHEN len(a) > 2 THEN a[3] ELSE coalesce(a[2], '') END AS title, a[1] AS day, CASE WHEN back = 2 THEN 'u' || row || ',u' || after ELSE 'u' || row END AS urls FROM r WHERE back > 1 OR n = 1""")
def listing_last_row(spark, d):
    """title = the third of more than two parts, else the second; the last row of a page leaves its urls to the row before."""
    e = _listing(table(spark, d, "orders"))
    by = Window.partitionBy("page")
    r = e.withColumns({"back": F.row_number().over(by.orderBy(F.desc("row"))), "after": F.lead("row").over(by.orderBy("row")), "n": F.count("*").over(by)}).where("back > 1 or n = 1")
    title = F.when(F.size("a") > 2, F.get("a", F.lit(2))).otherwise(F.coalesce(F.get("a", F.lit(1)), F.lit("")))
    url = F.concat(F.lit("u"), F.col("row").cast("string"))
    urls = F.when(F.col("back") == 2, F.concat(url, F.lit(",u"), F.col("after").cast("string"))).otherwise(url)
    return r.select("page", "row", title.alias("title"), F.get("a", F.lit(0)).alias("day"), urls.alias("urls"))


# --- text checks ----------------------------------------------------------------------------------------------------

# Patterns of subheadings.
SUBHEADINGS = (r"^\d+\.\d+\.\d+\s+[A-Z]", r"^[a-z]\.\s+[A-Z]", r"^\([a-z]\)\s+[A-Z]")


@query(rf"""WITH {LINES}, t AS (SELECT doc_id, pdf_idx, predicted, (['1.2.3 ', 'a. ', '(b) ', '', 'B. '])[1 + pdf_idx % 5] || text AS t FROM L)
SELECT doc_id, pdf_idx, predicted = 3 OR {" OR ".join(f"regexp_matches(trim(t), '{p}')" for p in SUBHEADINGS)} AS is_subheading FROM t""")
def subheadings(spark, d):
    """Continued headings, and lines whose number or letter stands before a capital."""
    marks = F.array(*map(F.lit, ("1.2.3 ", "a. ", "(b) ", "", "B. ")))
    t = F.trim(F.concat(F.get(marks, (F.col("pdf_idx") % 5).cast("int")), F.col("text")))
    hit = F.col("predicted") == 3
    for p in SUBHEADINGS:
        hit |= t.rlike(p)
    return lines_of(spark, d).select("doc_id", "pdf_idx", hit.alias("is_subheading"))


@query(rf"""WITH {LINES}, t AS (SELECT doc_id, pdf_idx, CASE pdf_idx % 3 WHEN 0 THEN '**' WHEN 1 THEN 'Here it is: **' ELSE '' END || text || ' ## part - **point** end' AS t FROM L), f AS (SELECT doc_id, pdf_idx, replace(replace(t, '- **', chr(10) || '- **'), ' #', chr(10) || '#') AS t FROM t)
SELECT doc_id, pdf_idx, NOT starts_with(t, '**') AS has_preface, CASE WHEN starts_with(t, '**') THEN t ELSE array_to_string(string_split(t, '**')[2:], '** ') END AS body FROM f""")
def markdown_fixes(spark, d):
    """Lists and headings of a summary on lines of their own; what stands before its first bold part goes."""
    k = F.col("pdf_idx") % 3
    t = F.concat(F.when(k == 0, "**").when(k == 1, "Here it is: **").otherwise(""), F.col("text"), F.lit(" ## part - **point** end"))
    t = F.replace(F.replace(t, F.lit("- **"), F.lit("\n- **")), F.lit(" #"), F.lit("\n#"))
    f = lines_of(spark, d).select("doc_id", "pdf_idx", t.alias("t"))
    parts = F.split("t", r"\*\*")
    return f.select("doc_id", "pdf_idx", (~F.col("t").startswith("**")).alias("has_preface"), F.when(F.col("t").startswith("**"), F.col("t")).otherwise(F.array_join(F.slice(parts, 2, F.size(parts)), "** ")).alias("body"))


@query(rf"""WITH {LINES}, t AS (SELECT doc_id, pdf_idx, CASE pdf_idx % 4 WHEN 0 THEN '§ ' || text WHEN 1 THEN text || '-' WHEN 2 THEN text || ' ..... 12 ....' ELSE text END AS t FROM L),
a AS (SELECT doc_id, pdf_idx, replace(t, ' ', '') AS x, t AS y FROM t), b AS (SELECT doc_id, pdf_idx, CASE WHEN starts_with(x, '§') THEN trim(x[2:]) ELSE x END AS x, CASE WHEN starts_with(x, '§') THEN trim(y[2:]) ELSE y END AS y FROM a),
c AS (SELECT doc_id, pdf_idx, CASE WHEN x[-1:] = '-' THEN x[:-2] ELSE x END AS x, CASE WHEN x[-1:] = '-' THEN y[:-2] ELSE y END AS y FROM b),
e AS (SELECT *, right(x, 2) = '..' AND length(x) - length(replace(x, '.', '')) > 2 AS l FROM c)
SELECT doc_id, pdf_idx, CASE WHEN l THEN substr(x, 1, instr(x, '..') - 1) ELSE x END AS key, CASE WHEN l THEN substr(y, 1, CASE WHEN instr(y, '..') > 0 THEN instr(y, '..') ELSE instr(y, '. .') END - 1) ELSE y END AS line FROM e""")
def label_keys(spark, d):
    """A line without its section sign, last hyphen and dotted leader, and the same without spaces as its key."""
    k, text = F.col("pdf_idx") % 4, F.col("text")
    y = F.when(k == 0, F.concat(F.lit("§ "), text)).when(k == 1, F.concat(text, F.lit("-"))).when(k == 2, F.concat(text, F.lit(" ..... 12 ...."))).otherwise(text)
    t = lines_of(spark, d).select("doc_id", "pdf_idx", F.replace(y, F.lit(" "), F.lit("")).alias("x"), y.alias("y"))
    cut = lambda c, a, n: F.substring(F.col(c), F.lit(a), n)
    sign = F.col("x").startswith("§")
    t = t.select("doc_id", "pdf_idx", *(F.when(sign, F.trim(cut(c, 2, F.length(c)))).otherwise(F.col(c)).alias(c) for c in "xy"))
    hyphen = F.col("x").endswith("-")
    t = t.select("doc_id", "pdf_idx", *(F.when(hyphen, cut(c, 1, F.length(c) - 1)).otherwise(F.col(c)).alias(c) for c in "xy"))
    leader = F.col("x").endswith("..") & (F.length("x") - F.length(F.replace("x", F.lit("."), F.lit(""))) > 2)
    end = F.when(F.instr("y", "..") > 0, F.instr("y", "..")).otherwise(F.instr("y", ". ."))
    return t.select("doc_id", "pdf_idx", F.when(leader, cut("x", 1, F.instr("x", "..") - 1)).otherwise(F.col("x")).alias("key"), F.when(leader, cut("y", 1, end - 1)).otherwise(F.col("y")).alias("line"))


@query(f"""WITH {LINES}, p AS (SELECT doc_id, pdf_idx, text AS content, CASE pdf_idx % 3 WHEN 0 THEN array_to_string(string_split(text, ' ')[2:4], ' ') WHEN 1 THEN array_to_string(list_reverse(string_split(text, ' ')[1:3]), ' ') ELSE string_split(text, ' ')[1] END AS sent FROM L)
SELECT doc_id, pdf_idx, sent, len(list_filter(string_split(sent, ' '), lambda w: NOT list_contains(string_split(content, ' '), w))) = 0 AS available,
 instr(content, trim(sent)) > 0 AND instr(replace(substr(content, instr(content, trim(sent))), ' ', ''), replace(sent, ' ', '')) > 0 AS in_order FROM p""")
def words_in_order(spark, d):
    """Whether all words of a text stand in another one, and stand there in their order."""
    words = F.split("text", " ")
    k = F.col("pdf_idx") % 3
    sent = F.when(k == 0, F.array_join(F.slice(words, 2, 3), " ")).when(k == 1, F.array_join(F.reverse(F.slice(words, 1, 3)), " ")).otherwise(F.get(words, F.lit(0)))
    p = lines_of(spark, d).select("doc_id", "pdf_idx", F.col("text").alias("content"), sent.alias("sent"))
    at = F.instr("content", F.trim("sent"))
    joined = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    there = F.instr(joined(F.substring(F.col("content"), at, F.length("content"))), joined(F.col("sent"))) > 0
    return p.select("doc_id", "pdf_idx", "sent", F.forall(F.split("sent", " "), lambda w: F.array_contains(F.split("content", " "), w)).alias("available"), ((at > 0) & there).alias("in_order"))


# --- evaluation -----------------------------------------------------------------------------------------------------

_AUC = f"""WITH {LINES}, s AS (SELECT labelled AS c, unnest(range(5)) AS k, doc_id, pdf_idx, predicted FROM L WHERE labelled < 5),
v AS (SELECT c, k, ((doc_id * 7 + pdf_idx * 3 + k * 5) % 20 + CASE WHEN predicted = k THEN 15 ELSE 0 END)::INT AS score FROM s), h AS (SELECT c, k, score, count(*) AS n FROM v GROUP BY 1, 2, 3),
p AS (SELECT a.c AS i, b.c AS j, sum(a.n::HUGEINT * b.n * CASE WHEN a.score > b.score THEN 2 WHEN a.score = b.score THEN 1 ELSE 0 END) AS w, sum(a.n::HUGEINT * b.n) AS n FROM h a JOIN h b ON a.k = b.k AND a.k = a.c AND a.c <> b.c GROUP BY 1, 2)"""


@query(_AUC + " SELECT least(i, j)::INT AS class_a, greatest(i, j)::INT AS class_b, round(avg(w::DOUBLE / (2 * n::DOUBLE)), 6) AS auc FROM p GROUP BY 1, 2")
def auc_pairs(spark, d):
    """Area under the curve of each pair of classes, one against one, from counts of scores."""
    lines = lines_of(spark, d).where("labelled < 5").select(F.col("labelled").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"), "doc_id", "pdf_idx", "predicted")
    score = (F.col("doc_id") * 7 + F.col("pdf_idx") * 3 + F.col("k") * 5) % 20 + F.when(F.col("predicted") == F.col("k"), 15).otherwise(0)
    h = lines.groupBy("c", "k", score.cast("int").alias("score")).agg(F.count("*").alias("n"))  # at most classes squared times scores
    a, b = h.where("k = c").select("k", F.col("c").alias("i"), F.col("score").alias("sa"), F.col("n").alias("na")), h.select("k", F.col("c").alias("j"), F.col("score").alias("sb"), F.col("n").alias("nb"))
    pair = F.col("na").cast("double") * F.col("nb")
    won = F.when(F.col("sa") > F.col("sb"), 1.0).when(F.col("sa") == F.col("sb"), 0.5).otherwise(0.0)
    p = a.join(b, "k").where("i != j").groupBy("i", "j").agg((F.sum(pair * won) / F.sum(pair)).alias("auc"))
    return p.groupBy(F.least("i", "j").alias("class_a"), F.greatest("i", "j").alias("class_b")).agg(F.round(F.avg("auc"), 6).alias("auc"))


@query(f"""WITH {LINES}, p AS (SELECT labelled, predicted, (50 + (doc_id * 7 + pdf_idx * 3) % 50)::DOUBLE / 100 AS conf FROM L)
SELECT labelled, count(*) AS n, round(avg((labelled <> predicted)::INT), 6) AS error_rate, round(avg(conf) FILTER (labelled <> predicted), 6) AS conf_wrong, round(avg(conf) FILTER (labelled = predicted), 6) AS conf_right,
 round(avg(CASE WHEN conf > 0.5 THEN conf END), 6) AS conf_mean FROM p GROUP BY 1""")
def error_rates(spark, d):
    """Error rate of each class, mean confidence of right and wrong rows, and of those above a floor."""
    conf = (50 + (F.col("doc_id") * 7 + F.col("pdf_idx") * 3) % 50).cast("double") / 100
    wrong = F.col("labelled") != F.col("predicted")
    p = lines_of(spark, d).select("labelled", wrong.alias("wrong"), conf.alias("conf"))
    mean = lambda c: F.round(F.avg(F.when(c, F.col("conf"))), 6)
    return p.groupBy("labelled").agg(F.count("*").alias("n"), F.round(F.avg(F.col("wrong").cast("int")), 6).alias("error_rate"), mean(F.col("wrong")).alias("conf_wrong"), mean(~F.col("wrong")).alias("conf_right"), mean(F.col("conf") > 0.5).alias("conf_mean"))


@query("""WITH a AS (SELECT doc_id, 'doc_' || doc_id || '.csv' AS name FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, 'doc_' || doc_id || '.csv' AS name FROM documents WHERE doc_id % 5 <> 0)
SELECT name, a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL AS paired FROM a FULL JOIN b USING (name)""")
def paired_files(spark, d):
    """Labelled and predicted files paired by name, not by the order of a listing; those without a partner are told."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("name")
    docs = table(spark, d, "documents")
    a, b = docs.where("doc_id % 3 != 0").select(name, F.lit(True).alias("a")), docs.where("doc_id % 5 != 0").select(name, F.lit(True).alias("b"))
    return a.join(b, "name", "full").select("name", (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("paired"))
