"""Queries of text cleaning, similarity, intervals, chunks and names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.functions import text
from vellum.plans.registry import query
from vellum.sources.tables import LINES, in_order, lines_of, table

def _ascii(c):
    """Other characters as question marks: the SQL engine's edit distance counts bytes."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


_WORDS = r"list_filter(regexp_split_to_array({0}, '[ \t\r\n\f\x0B]+'), lambda w: w <> '')"


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, {text.CLEAN_SQL.format('text')} AS cleaned, {text.MATCHING_SQL.format('text')} AS for_matching, lower(regexp_replace(text, '[ \\t\\r\\n\\f\\x0B]', '', 'g')) AS key FROM L")
def clean_text(spark, d):
    """Forms of a line for comparison."""
    t = F.col("text")
    return lines_of(spark, d).select("doc_id", "pdf_idx", text.clean_text(t).alias("cleaned"), text.clean_for_matching(t).alias("for_matching"), text.key_text(t).alias("key"))


@query(rf"""WITH {LINES}, p AS (SELECT doc_id, pdf_idx, text AS a, lead(text) OVER (PARTITION BY doc_id ORDER BY pdf_idx) AS b FROM L), q AS (SELECT doc_id, pdf_idx, regexp_replace(a, '[^\x00-\x7F]', '?', 'g') AS a, regexp_replace(b, '[^\x00-\x7F]', '?', 'g') AS b FROM p WHERE b IS NOT NULL)
SELECT doc_id, pdf_idx, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE 1 - levenshtein(trim(a), trim(b)) / greatest(length(a), length(b))::DOUBLE END, 6) AS similarity FROM q""")
def line_similarity(spark, d):
    """Edit-distance similarity of neighbouring lines (letters beyond ASCII alike)."""
    p = lines_of(spark, d).select("doc_id", "pdf_idx", _ascii(F.col("text")).alias("a"))
    p = p.withColumn("b", F.lead("a").over(in_order())).where("b is not null")
    return p.select("doc_id", "pdf_idx", F.round(text.similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


_POSITION = f"""{LINES}, b AS (SELECT item_id, regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g'), '\\s+', ' ', 'g') AS block FROM benchmark), q AS (SELECT item_id, block, substr(block, 1 + (item_id * 7)::INT % 40, 30) AS probe FROM b),
 o AS (SELECT item_id, probe, unnest(range(1, length(block) + 1)) AS s, block FROM q)"""


@query(f"""WITH {_POSITION}, w AS (SELECT item_id, s::INT AS s, levenshtein(probe, substr(block, s, length(probe))) AS dist FROM o WHERE s = 1 OR substr(block, s - 1, 1) = ' ')
SELECT item_id, arg_min(s, struct_pack(a := dist, b := s)) AS best_start, min(dist)::BIGINT AS distance FROM w GROUP BY 1""")
def best_position(spark, d):
    """The word start of a block where a text fits best; exact containment would be distance 0."""
    q = table(spark, d, "benchmark").select("item_id", F.regexp_replace(_ascii(F.col("text")), r"\s+", " ").alias("block"))
    q = q.withColumn("probe", F.substring(F.col("block"), 1 + (F.col("item_id") * 7).cast("int") % 40, F.lit(30)))
    w = q.select("item_id", "block", "probe", F.explode(F.sequence(F.lit(1), F.length("block"))).alias("s"))
    w = w.where((F.col("s") == 1) | (F.substring(F.col("block"), F.col("s") - 1, F.lit(1)) == " "))
    w = w.select("item_id", "s", F.levenshtein("probe", F.substring(F.col("block"), F.col("s"), F.length("probe"))).alias("dist"))
    return w.groupBy("item_id").agg(F.min_by("s", F.struct("dist", "s")).alias("best_start"), F.min("dist").cast("long").alias("distance"))


@query("""WITH i AS (SELECT user_id, event_id AS s, event_id + floor(value * 3)::BIGINT AS e FROM events), m AS (SELECT *, coalesce((s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::INT, 0) AS nw FROM i),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY user_id, g""")
def merge_intervals(spark, d):
    """Overlapping closed intervals merged: running maximum and islands."""
    w = Window.partitionBy("user_id").orderBy("s", "e")
    i = table(spark, d, "events").select("user_id", F.col("event_id").alias("s"), (F.col("event_id") + F.floor(F.col("value") * 3).cast("long")).alias("e"))
    i = i.withColumn("nw", F.coalesce((F.col("s") > F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(0)))
    i = i.withColumn("g", F.sum("nw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return i.groupBy("user_id", "g").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n")).drop("g")


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, regexp_matches(replace(text, ' ', ''), '\\.{{5,}}|-{{5,}}|_{{5,}}') AS is_toc,
 regexp_matches(text, '^[0-9]+(\\.[0-9]+)*\\.?\\s') AS numbered, regexp_matches(text, '^\\(?([ivxlcdm]+|[a-z]|[0-9]+)[.)]') AS compound FROM L""")
def toc_lines(spark, d):
    """Dotted leaders, numbered and compound first words, subheadings."""
    t = F.col("text")
    return lines_of(spark, d).select("doc_id", "pdf_idx", text.dotted_leader(t).alias("is_toc"), t.rlike(r"^[0-9]+(\.[0-9]+)*\.?\s").alias("numbered"), t.rlike(r"^\(?([ivxlcdm]+|[a-z]|[0-9]+)[.)]").alias("compound"))


@query("""WITH p AS (SELECT p_partkey, p_name AS a, p_type AS b FROM part) SELECT p_partkey, (len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: substr(a, i::BIGINT, 1) = substr(b, i::BIGINT, 1))) * 2 >= least(length(a), length(b))) AS in_common,
 len(list_filter(string_split(lower(a), ' '), lambda w: NOT list_contains(string_split(lower(b), ' '), w))) = 0 AS all_words FROM p""")
def letters_in_common(spark, d):
    """Positional equality of half the letters; all words available."""
    a, b = F.col("p_name"), F.col("p_type")
    n = F.least(F.length(a), F.length(b))
    same = F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y) & (x != "")), lambda x: F.coalesce(x, F.lit(False)))
    words = lambda c: F.split(F.lower(c), " ")
    return table(spark, d, "part").select("p_partkey", (F.size(same) * 2 >= n).alias("in_common"), F.forall(words(a), lambda w: F.array_contains(words(b), w)).alias("all_words"))


@query("""SELECT page_id, regexp_replace(html, '<[^>]*>?', '', 'g') AS plain, regexp_replace(html, '&#([a-zA-Z0-9]+);?', '[#\\1;]', 'g') AS guarded FROM pages""")
def strip_tags(spark, d):
    """T19, S1i: tags out, entities guarded."""
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", text.strip_tags(h).alias("plain"), text.entity_guard(h).alias("guarded"))


@query(f"""WITH {LINES}, w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents) SELECT doc_id, (i // 128)::INT AS chunk, array_to_string(w[i + 1:i + 128], ' ') AS text FROM (SELECT doc_id, w, unnest(range(0, len(w), 128)) AS i FROM w)""")
def chunk_128(spark, d):
    """Parts of 128 words."""
    parts = table(spark, d, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"), 128)).alias("chunk", "text"))
    return parts


@query(r"""SELECT page_id, regexp_replace(regexp_replace(url, '[\\/:*?"<>|\s]+', '_', 'g'), '_+', '_', 'g') AS file_name, regexp_replace(string_split(url, '/')[-1], '[?#].*', '') AS last_part,
 regexp_matches(url, '\.html?([?#]|$)') AS is_html, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages""")
def file_names(spark, d):
    """Names for files, parts of urls."""
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", text.file_name(u).alias("file_name"), F.regexp_replace(F.element_at(F.split(u, "/"), -1), "[?#].*", "").alias("last_part"), u.rlike(r"\.html?([?#]|$)").alias("is_html"), F.regexp_extract(u, "^[a-z]+://([^/?#]+)", 1).alias("host"))


@query(r"""WITH t AS (SELECT p_partkey, 'Spec rev.' || (p_size % 7) || '.' || (p_partkey % 5) AS t FROM part) SELECT p_partkey, regexp_extract(lower(t), 'rev\.?\s*([0-9]+(?:\.[0-9]+)*)', 1) AS revision,
 string_split(regexp_extract(lower(t), 'rev\.?\s*([0-9]+(?:\.[0-9]+)*)', 1), '.')[1]::INT AS major FROM t""")
def revisions(spark, d):
    """Revision numbers of a text."""
    t = F.concat(F.lit("Spec rev."), (F.col("p_size") % 7).cast("string"), F.lit("."), (F.col("p_partkey") % 5).cast("string"))
    p = table(spark, d, "part").select("p_partkey", text.revision(t).alias("r"))
    return p.select("p_partkey", F.array_join(F.transform("r", lambda x: x.cast("string")), ".").alias("revision"), F.get("r", F.lit(0)).alias("major"))


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d %B %Y') WHEN 1 THEN strftime(o_orderdate, '%d %b %Y') WHEN 2 THEN strftime(o_orderdate, '%d.%m.%Y') ELSE 'no date' END AS t FROM orders)
SELECT o_orderkey, t AS text, coalesce(try_strptime(t, '%d %B %Y'), try_strptime(t, '%d %b %Y'), try_strptime(t, '%d.%m.%Y'))::DATE AS day FROM t""")
def parse_dates(spark, d):
    """Dates in one of several forms, null for others."""
    k, o = F.col("o_orderkey") % 4, F.col("o_orderdate")
    t = F.when(k == 0, F.date_format(o, "dd MMMM yyyy")).when(k == 1, F.date_format(o, "dd MMM yyyy")).when(k == 2, F.date_format(o, "dd.MM.yyyy")).otherwise("no date")
    day = F.coalesce(*(F.try_to_date(t, f) for f in ("dd MMMM yyyy", "dd MMM yyyy", "dd.MM.yyyy")))
    return table(spark, d, "orders").select("o_orderkey", t.alias("text"), day.alias("day"))


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, regexp_replace(regexp_replace(translate(text, '§“”‘’–', ''), '\\.{{2,}}', '.', 'g'), '-$', '') AS cleaned, starts_with(lower(text), 'the ') AS has_prefix,
 CASE WHEN starts_with(text, 'The ') THEN substr(text, 5) ELSE text END AS without_prefix, regexp_replace(text, '[^a-zA-Z]', '', 'g') AS letters, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS header_key FROM L""")
def pre_label_cleaning(spark, d):
    """Punctuation, leaders and prefixes."""
    t = F.col("text")
    cleaned = F.regexp_replace(F.regexp_replace(F.translate(t, "§“”‘’–", ""), r"\.{2,}", "."), "-$", "")
    return lines_of(spark, d).select(
        "doc_id", "pdf_idx", cleaned.alias("cleaned"), F.lower(t).startswith("the ").alias("has_prefix"), F.when(t.startswith("The "), F.substring(t, 5, 1 << 30)).otherwise(t).alias("without_prefix"),
        F.regexp_replace(t, "[^a-zA-Z]", "").alias("letters"), F.regexp_replace(F.lower(t), "[^a-z0-9]", "").alias("header_key"),
    )


@query(f"""WITH {LINES}, c AS (SELECT doc_id, pdf_idx, {text.CLEAN_SQL.format('text')} AS a, {text.CLEAN_SQL.format("replace(text, 'on', 'in')")} AS b FROM L) SELECT * FROM c WHERE a <> b""")
def imperfect_matches(spark, d):
    """Lines whose cleaned text differs from the matched text's."""
    c = lines_of(spark, d).select("doc_id", "pdf_idx", text.clean_text(F.col("text")).alias("a"), text.clean_text(F.replace(F.col("text"), F.lit("on"), F.lit("in"))).alias("b"))
    return c.where("a != b")


@query(r"""WITH r AS (SELECT n_nationkey, (['i','ii','iii','iv','v','vi','vii','viii','ix','x'])[1 + n_nationkey % 10] AS label FROM nation) SELECT n_nationkey, label, (1 + n_nationkey % 10)::INT AS page, (1 + n_nationkey % 10 + 4)::INT AS shifted FROM r""")
def page_labels(spark, d):
    """S5d: roman page labels to numbers, with an offset."""
    roman = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")
    n = table(spark, d, "nation").select("n_nationkey", F.get(F.array(*map(F.lit, roman)), (F.col("n_nationkey") % 10).cast("int")).alias("label"))
    dim = spark.createDataFrame([(x, i + 1) for i, x in enumerate(roman)], "label string, page int")
    return n.join(dim, "label").select("n_nationkey", "label", "page", (F.col("page") + 4).alias("shifted"))
