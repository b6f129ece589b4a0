"""Queries over the line table: scan, features, neighbours, repair, merging, layout."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.functions import layout, text
from vellum.operators import sequence
from vellum.plans.registry import query
from vellum.schema import class_name
from vellum.sources.tables import in_order, LINES, lines_of, table

# Fixed value: a page with more rows than this is valid.
VALID_ROWS = 20
W = "WINDOW w AS (PARTITION BY doc_id ORDER BY pdf_idx)"
NAME_SQL = "(['PARAGRAPH','PARAGRAPH_CONT','HEADING','HEADING_CONT','TOC','TABLE','HEADER','FOOTER','FOOT_NOTE','DEFINITION','BULLET_LIST','ENUM_LIST','GEN_LIST_CONT','BULLET_LIST_CONT','ENUM_LIST_CONT'])[{0} + 1]"


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, page, text FROM L")
def lines_scan(spark, d):
    """Lines right-trimmed, blank ones dropped, densely numbered."""
    return lines_of(spark, d).select("doc_id", "pdf_idx", "page", "text")


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, {text.FEATURES_SQL} FROM L")
def text_features(spark, d):
    """All text features from one registry of columns."""
    return lines_of(spark, d).select("doc_id", "pdf_idx", *(c.cast("int").alias(k) for k, c in text.text_features(F.col("text")).items()))


_GEOMETRY = """CASE ncols WHEN 1 THEN line_x0 WHEN 2 THEN line_x0 - block_x0 ELSE 0 END AS left_indent,
 CASE ncols WHEN 1 THEN page_width - line_x1 WHEN 2 THEN block_x1 - line_x1 ELSE 0 END AS right_space"""


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, {_GEOMETRY}, font_size::DOUBLE AS font_size, contains(lower(family), 'bold')::INT AS is_bold,
 contains(lower(family), 'italic')::INT AS is_italic, CASE WHEN is_table THEN 5 WHEN is_header THEN 6 WHEN is_footer THEN 7 END AS extracted FROM L""")  # fmt: skip
def geometry_features(spark, d):
    """indents, fonts, extracted class."""
    low = F.lower("family")
    return lines_of(spark, d).select(
        "doc_id", "pdf_idx", layout.left_indent().alias("left_indent"), layout.right_space().alias("right_space"), F.col("font_size").cast("double").alias("font_size"),
        low.contains("bold").cast("int").alias("is_bold"), low.contains("italic").cast("int").alias("is_italic"), layout.extracted_class().alias("extracted"),
    )


_SPACES = """CASE WHEN lag(page) OVER w = page AND line_y0 - lag(line_y0) OVER w > 0 THEN line_y0 - lag(line_y0) OVER w END AS space_above,
 CASE WHEN lead(page) OVER w = page AND lead(line_y0) OVER w - line_y0 > 0 THEN lead(line_y0) OVER w - line_y0 END AS space_below"""


@query(f"""WITH {LINES}, s AS (SELECT *, {_SPACES}, coalesce((family <> lag(family) OVER w)::INT, 1) AS family_changed,
  coalesce((page <> lag(page) OVER w)::INT, 1) AS prev_page_diff, coalesce((page <> lead(page) OVER w)::INT, 1) AS next_page_diff FROM L {W})
SELECT doc_id, pdf_idx, space_above, space_below, family_changed, prev_page_diff, next_page_diff,
  CASE WHEN space_below > space_above + 1.5 THEN 1 WHEN space_below < space_above - 1.5 THEN -1 ELSE 0 END AS more_space_below FROM s""")  # fmt: skip
def change_flags(spark, d):
    """Distances and changes to neighbours, none across page edges."""
    s = lines_of(spark, d).select(
        "*", *(c.alias(k) for k, c in layout.spaces().items()), layout.change(F.col("family"), F.lag("family").over(in_order())).alias("family_changed"),
        layout.change(F.col("page"), F.lag("page").over(in_order())).alias("prev_page_diff"), layout.change(F.col("page"), F.lead("page").over(in_order())).alias("next_page_diff"),
    )
    more = F.when(F.col("space_below") > F.col("space_above") + 1.5, 1).when(F.col("space_below") < F.col("space_above") - 1.5, -1).otherwise(0)
    return s.select("doc_id", "pdf_idx", "space_above", "space_below", "family_changed", "prev_page_diff", "next_page_diff", more.alias("more_space_below"))


def _ternary_sql(c, o, t=0.0):
    return f"CASE WHEN {c} IS NULL AND {o} IS NULL THEN 0 WHEN {c} IS NULL OR {o} IS NULL THEN 1 WHEN {c} > {o} + {t} THEN 1 WHEN {c} < {o} - {t} THEN -1 ELSE 0 END"


@query(f"""WITH {LINES}, s AS (SELECT *, {_SPACES}, {_GEOMETRY} FROM L {W})
SELECT doc_id, pdf_idx, {_ternary_sql("space_below", "lag(space_below) OVER w")} AS space_below_diff, {_ternary_sql("left_indent", "lag(left_indent) OVER w")} AS left_diff,
  {_ternary_sql("right_space", "lead(right_space) OVER w", 20.0)} AS next_right_diff, {_ternary_sql("font_size", "lag(font_size) OVER w")} AS font_diff FROM s {W}""")  # fmt: skip
def ternary_diffs(spark, d):
    """Signs of differences with a threshold, by the null rules."""
    s = lines_of(spark, d).withColumns({**layout.spaces(), "left_indent": layout.left_indent(), "right_space": layout.right_space()})
    back, ahead = (lambda c: F.lag(c).over(in_order())), (lambda c: F.lead(c).over(in_order()))
    t = layout.ternary
    return s.select(
        "doc_id", "pdf_idx", t(F.col("space_below"), back("space_below")).alias("space_below_diff"), t(F.col("left_indent"), back("left_indent")).alias("left_diff"),
        t(F.col("right_space"), ahead("right_space"), 20.0).alias("next_right_diff"), t(F.col("font_size"), back("font_size")).alias("font_diff"),
    )


def _bin_sql(v, f):
    steps = (-2.0, -1.0, -0.5, -0.125, 0.125, 0.5, 1.0, 2.0)
    return f"CASE WHEN {v} IS NULL THEN NULL " + " ".join(f"WHEN {v} <= m_{f} + {k} * s_{f} THEN {i}" for i, k in enumerate(steps)) + " ELSE 8 END"


_BIN = ("left_indent", "num_chars", "space_below")
_BINNED = f"""f AS (SELECT doc_id, pdf_idx, {_GEOMETRY}, length(text) AS num_chars, {_SPACES} FROM L {W}),
 st AS (SELECT *, {", ".join(f"avg({f}) OVER (PARTITION BY doc_id) AS m_{f}, stddev_pop({f}) OVER (PARTITION BY doc_id) AS s_{f}" for f in _BIN)} FROM f),
 c AS (SELECT *, {", ".join(f"{_bin_sql(f, f)} AS c_{f}, {_bin_sql(f'm_{f}', f)} AS k_{f}" for f in _BIN)} FROM st),
 g AS (SELECT *, {", ".join(f"min(c_{f}) OVER (PARTITION BY doc_id) AS l_{f}" for f in _BIN)} FROM c),
 binned AS (SELECT doc_id, pdf_idx, {", ".join(f"CASE WHEN s_{f} IS NULL OR s_{f} < 1e-10 THEN 4 ELSE greatest(0, least(8, coalesce(c_{f}, k_{f}) - l_{f})) END::INT AS {f}_binned" for f in _BIN)} FROM g)"""


@query(f"WITH {LINES}, {_BINNED} SELECT * FROM binned")
def bin_features(spark, d):
    """nine bins around a document's mean; null takes the mean's bin, constants take 4."""
    f = lines_of(spark, d).withColumns(layout.spaces()).select("doc_id", "pdf_idx", layout.left_indent().alias("left_indent"), F.length("text").alias("num_chars"), "space_below")
    return layout.binned(f, list(_BIN)).select("doc_id", "pdf_idx", *(f"{x}_binned" for x in _BIN))


@query(f"""WITH {LINES}, {_BINNED} SELECT doc_id, pdf_idx, {_ternary_sql("left_indent_binned", "lead(left_indent_binned) OVER w")} AS next_left_diff,
  {_ternary_sql("num_chars_binned", "lead(num_chars_binned) OVER w")} AS next_chars_diff FROM binned {W}""")
def binned_diffs(spark, d):
    """Differences to the next line, of bins."""
    t = lambda c: layout.ternary(F.col(c), F.lead(c).over(in_order()))
    return bin_features(spark, d).select("doc_id", "pdf_idx", t("left_indent_binned").alias("next_left_diff"), t("num_chars_binned").alias("next_chars_diff"))


@query(f"""WITH {LINES}, x AS (SELECT doc_id, x FROM (SELECT doc_id, length(text)::DOUBLE AS x FROM L)), e AS (SELECT doc_id, quantile_cont(x, [0.111, 0.222, 0.333, 0.444, 0.555, 0.666, 0.777, 0.888]) AS q FROM x GROUP BY 1)
SELECT doc_id, list_transform(q, lambda v: round(v, 6)) [1] AS q1, round(q[4], 6) AS q4, round(q[8], 6) AS q8 FROM (SELECT doc_id, q FROM e)""".replace("list_transform(q, lambda v: round(v, 6)) [1]", "round(q[1], 6)"))  # fmt: skip
def quantile_edges(spark, d):
    """Inner quantile edges of a feature, interpolated."""
    q = F.expr("percentile(cast(length(text) as double), array(0.111, 0.222, 0.333, 0.444, 0.555, 0.666, 0.777, 0.888))")
    e = lines_of(spark, d).groupBy("doc_id").agg(q.alias("q"))
    return e.select("doc_id", *(F.round(F.get("q", F.lit(i)), 6).alias(f"q{i + 1}") for i in (0, 3, 7)))


_SHIFTED = ("font_size", "line_x0", "page")


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, {', '.join(f'{c}, lead({c}) OVER w AS {c}_next, lag({c}) OVER w AS {c}_prev' for c in _SHIFTED)} FROM L {W}")
def shifted_matrix(spark, d):
    """Features of the lines before and after, inside a document only."""
    return lines_of(spark, d).select("doc_id", "pdf_idx", *(x for c in _SHIFTED for x in (F.col(c), F.lead(c).over(in_order()).alias(f"{c}_next"), F.lag(c).over(in_order()).alias(f"{c}_prev"))))


_SHIFTS = tuple(re.findall(r"AS (\w+)", text.FEATURES_SQL))


@query(f"""WITH {LINES}, f AS (SELECT doc_id, pdf_idx, {text.FEATURES_SQL} FROM L)
SELECT doc_id, pdf_idx, {", ".join(f'{c}::INT AS {c}, lead({c}) OVER w::INT AS "{c}_shift_-1", lag({c}) OVER w::INT AS "{c}_shift_1"' for c in _SHIFTS)} FROM f {W}""")
def shifted_features(spark, d):
    """All text features of each line, of the line after it (-1) and of the one before it (1), in one pass."""
    f = lines_of(spark, d).select("doc_id", "pdf_idx", *(c.cast("int").alias(k) for k, c in text.text_features(F.col("text")).items()))
    shifts = [x for c in _SHIFTS for x in (F.col(c), F.lead(c).over(in_order()).alias(f"{c}_shift_-1"), F.lag(c).over(in_order()).alias(f"{c}_shift_1"))]
    return f.select("doc_id", "pdf_idx", *shifts)


_FINAL = f"coalesce(CASE WHEN is_table THEN 5 WHEN is_header THEN 6 WHEN is_footer THEN 7 END, predicted)"  # noqa: F541


@query(f"""WITH {LINES}, c AS (SELECT {_FINAL} AS cls, count(*) AS n FROM L GROUP BY 1)
SELECT cls, {NAME_SQL.format("cls")} AS class_name, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM c""")
def class_distribution(spark, d):
    """Extracted class before predicted one, counts and shares."""
    cls = F.coalesce(layout.extracted_class(), F.col("predicted")).cast("int")
    counts = lines_of(spark, d).groupBy(cls.alias("cls")).agg(F.count("*").alias("n"))
    return counts.select("cls", class_name(F.col("cls")).alias("class_name"), "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("percent"))


def _repair_sql() -> str:
    steps, n = [], 0

    def step(expr: str) -> None:
        nonlocal n
        steps.append(f"r{n + 1} AS (SELECT * EXCLUDE (c), {expr} AS c FROM r{n})")
        n += 1

    contents = r"(len(ws) >= 3 AND regexp_matches(ws[1], '^\p{Nd}+$') AND regexp_matches(ws[-1], '^\p{Nd}+$'))"
    start = rf"""b AS (SELECT *, CASE WHEN regexp_matches(replace(text, ' ', ''), '\.{{5,}}') OR {contents} THEN 4
  WHEN lower(text) IN ('table of contents', 'list of figures', 'list of tables', 'contents') THEN 2 ELSE predicted END AS c
 FROM (SELECT *, list_filter(regexp_split_to_array(text, '[ \t\r\n\f\x0B]+'), lambda w: w <> '') AS ws FROM L)),
r0 AS (SELECT *, lag(c) OVER w AS p, lead(c) OVER w AS n, lag(font_size) OVER w AS f, lead(page) OVER w AS np FROM b {W})"""
    para, bullet, enum = "c IN (0, 1)", r"regexp_matches(text, '^(\[#\w+;\]|[#•]+\s)')", r"regexp_matches(text, '^(\d+\.\s|\(\d+\)\s|\([a-z]\)\s|[a-z]\.\s)')"
    for test, to in (
        ("c NOT IN (4, 2) AND p = 4 AND n = 4", 4), ("c = 3 AND font_size IS DISTINCT FROM f", 2), ("p = 2 AND c <> 2 AND n = 3", 3), ("c = 3 AND page IS DISTINCT FROM np", 2),
        ("p = 3 AND n = 0 AND c = 1", 3), ("p = 3 AND n = 1 AND c = 1", 0), ("starts_with(trim(text), '[#x2014;]') OR starts_with(trim(text), '[#x2022;]')", 10),
        (f"{para} AND (coalesce(p IN (10, 13), false) OR coalesce(n IN (10, 13), false)) AND {bullet}", 10),
        (f"{para} AND (coalesce(p IN (11, 14), false) OR coalesce(n IN (11, 14), false)) AND {enum}", 11), (f"c = 10 AND NOT {bullet}", 0),
    ):
        step(f"CASE WHEN {test} THEN {to} ELSE c END")
    follow = "CASE p WHEN 2 THEN 3 WHEN 0 THEN 1 WHEN 11 THEN 14 WHEN 10 THEN 13 WHEN 12 THEN 12 ELSE c END"
    for base, cont in ((2, 3), (0, 1), (11, 14), (10, 13), (12, 12)):
        steps.append(f"q{n} AS (SELECT *, lag(c) OVER w AS q FROM r{n} {W})")
        steps.append(f"r{n + 1} AS (SELECT * EXCLUDE (c, q), CASE WHEN c = {cont} AND q IS DISTINCT FROM {base} AND q IS DISTINCT FROM {cont} THEN {follow} ELSE c END AS c FROM q{n})")
        n += 1
    return f"WITH {LINES}, {start}, {', '.join(steps)}, final AS (SELECT * EXCLUDE (c), c::INT AS final FROM r{n})"


_REPAIR = _repair_sql()


@query(f"{_REPAIR} SELECT doc_id, pdf_idx, predicted, final FROM final")
def heuristic_rules(spark, d):
    """The cascade of rules on lines and their neighbours."""
    return sequence.repair(lines_of(spark, d)).select("doc_id", "pdf_idx", "predicted", "final")


_LISTS = "([10, 11, 12, 12, 0, 12]::INT[])[1 + (doc_id + pdf_idx * 5) % 6]"


@query(f"""WITH {LINES}, k AS (SELECT doc_id, pdf_idx, {_LISTS} AS cls FROM L), s AS (SELECT *, last_value(CASE WHEN cls IN (10, 11) THEN cls END IGNORE NULLS)
  OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING) AS seen FROM k)
SELECT doc_id, pdf_idx, cls, CASE WHEN cls = 12 THEN CASE WHEN coalesce(seen, 10) = 11 THEN 14 ELSE 13 END ELSE cls END AS carried FROM s""")
def gen_list_carry(spark, d):
    """General list continuations take the kind of the last item."""
    cls = F.get(F.array(*map(F.lit, (10, 11, 12, 12, 0, 12))), ((F.col("doc_id") + F.col("pdf_idx") * 5) % 6).cast("int"))
    return sequence.carry_list_kind(lines_of(spark, d).select("doc_id", "pdf_idx", cls.alias("cls")), "cls", "carried")


@query(f"""{_REPAIR}, a AS (SELECT *, {_FINAL.replace("predicted", "final")} AS cls FROM final),
e AS (SELECT *, cls IN (6, 7, 8) AS margin, NOT (page IS NOT DISTINCT FROM lag(page) OVER w AND ncols IS NOT DISTINCT FROM lag(ncols) OVER w) AS edge FROM a {W}),
f AS (SELECT *, cls IN (1, 3, 13, 14) AS cont, cls IN (2, 0, 11, 10, 12) OR (cls IN (1, 3, 13, 14) AND edge) AS base FROM e WHERE NOT margin),
g AS (SELECT *, CASE WHEN cont AND edge THEN CASE cls WHEN 1 THEN 0 WHEN 3 THEN 2 WHEN 13 THEN 10 ELSE 11 END ELSE cls END AS k,
  sum((base OR NOT cont OR edge)::INT) OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING) AS gid FROM f),
h AS (SELECT *, first_value(base) OVER v AS opened, row_number() OVER v AS nth FROM g WINDOW v AS (PARTITION BY doc_id, gid ORDER BY pdf_idx)),
m AS (SELECT doc_id, min(pdf_idx)::INT AS pdf_idx, arg_min(k, pdf_idx)::INT AS cls, arg_min(page, pdf_idx) AS page, string_agg(text, '' ORDER BY pdf_idx) AS text, count(*)::INT AS n_lines,
  min(line_x0) AS line_x0, min(line_y0) AS line_y0, max(line_x1) AS line_x1 FROM h WHERE (nth = 1 AND NOT (cont AND NOT base)) OR (nth > 1 AND opened) GROUP BY doc_id, gid)
SELECT * FROM m UNION ALL SELECT doc_id, pdf_idx, cls::INT, page, text, 1, line_x0, line_y0, line_x1 FROM e WHERE margin""")
def merge_lines(spark, d):
    """Repaired lines merged into paragraphs."""
    lines = sequence.repair(lines_of(spark, d)).withColumn("cls", F.coalesce(layout.extracted_class(), F.col("final")).cast("int"))
    return sequence.merge_lines(lines, "cls")


@query(f"""WITH {LINES}, x AS (SELECT *, (line_x0 + line_x1) / 2 AS x_mid FROM L),
n AS (SELECT *, coalesce((line_x0 > max(line_x1) OVER (PARTITION BY doc_id, page ORDER BY x_mid, pdf_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::INT, 0) AS nw FROM x),
i AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id, page ORDER BY x_mid, pdf_idx ROWS UNBOUNDED PRECEDING)::INT AS island FROM n)
SELECT doc_id, pdf_idx, page, island, row_number() OVER (PARTITION BY doc_id, page ORDER BY island, line_y0, pdf_idx)::INT - 1 AS block_order FROM i""")
def reading_order(spark, d):
    """Islands of x-centres, then y."""
    return layout.reading_order(lines_of(spark, d)).select("doc_id", "pdf_idx", "page", "island", "block_order")


@query(f"""WITH {LINES} SELECT doc_id, page, count(*) AS n_rows, (count(*) > {VALID_ROWS}) AS valid, CASE WHEN sum(CASE WHEN line_x0 < 306 AND line_x1 > 306 THEN length(text) ELSE 0 END) > 0.8 * sum(length(text)) THEN 1 ELSE 2 END AS columns_found,
  sum((line_x1 <= 306)::INT)::BIGINT AS left_lines, sum((line_x0 >= 306)::INT)::BIGINT AS right_lines FROM L GROUP BY 1, 2""")
def page_columns(spark, d):
    """S1j, L4, L6: page validity, column count by crossing text, occupancy."""
    crossing = F.when((F.col("line_x0") < 306) & (F.col("line_x1") > 306), F.length("text")).otherwise(0)
    return lines_of(spark, d).groupBy("doc_id", "page").agg(
        F.count("*").alias("n_rows"), (F.count("*") > VALID_ROWS).alias("valid"), F.when(F.sum(crossing) > 0.8 * F.sum(F.length("text")), 1).otherwise(2).alias("columns_found"),
        F.count_if(F.col("line_x1") <= 306).alias("left_lines"), F.count_if(F.col("line_x0") >= 306).alias("right_lines"),
    )


@query(f"""WITH {LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY line_y0, pdf_idx) AS up, row_number() OVER (PARTITION BY doc_id, page ORDER BY line_y0 DESC, pdf_idx DESC) AS down,
  line_y0 - lag(line_y0) OVER (PARTITION BY doc_id, page ORDER BY line_y0, pdf_idx) AS gap FROM L)
SELECT doc_id, up::INT AS slot, round(avg(gap), 6) AS mean_gap, count(gap) AS n FROM r WHERE (up <= 7 OR down <= 5) AND gap >= 7 GROUP BY 1, 2""")
def edge_gaps(spark, d):
    """Gaps of the first and last lines of pages."""
    page = Window.partitionBy("doc_id", "page")
    r = lines_of(spark, d).select(
        "doc_id", F.row_number().over(page.orderBy("line_y0", "pdf_idx")).alias("up"), F.row_number().over(page.orderBy(F.desc("line_y0"), F.desc("pdf_idx"))).alias("down"),
        (F.col("line_y0") - F.lag("line_y0").over(page.orderBy("line_y0", "pdf_idx"))).alias("gap"),
    )
    return r.where(((F.col("up") <= 7) | (F.col("down") <= 5)) & (F.col("gap") >= 7)).groupBy("doc_id", F.col("up").alias("slot")).agg(F.round(F.avg("gap"), 6).alias("mean_gap"), F.count("gap").alias("n"))


@query(f"""WITH {LINES}, s AS (SELECT doc_id, pdf_idx, line_x1, coalesce((abs(line_x1 - lag(line_x1) OVER w) > 60)::INT, 0) AS nw FROM L {W}),
i AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING)::INT AS cluster FROM s)
SELECT doc_id, cluster, min(line_x1) AS lo, max(line_x1) AS hi, count(*) AS n FROM i GROUP BY 1, 2""")
def value_clusters(spark, d):
    """Runs of neighbouring values within a tolerance."""
    s = lines_of(spark, d).withColumn("nw", F.coalesce((F.abs(F.col("line_x1") - F.lag("line_x1").over(in_order())) > 60).cast("int"), F.lit(0)))
    s = s.withColumn("cluster", F.sum("nw").over(in_order().rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return s.groupBy("doc_id", "cluster").agg(F.min("line_x1").alias("lo"), F.max("line_x1").alias("hi"), F.count("*").alias("n"))


@query(f"""WITH {LINES}, s AS (SELECT *, coalesce((abs(line_y0 - lag(line_y0) OVER w) > 14 OR page <> lag(page) OVER w)::INT, 1) AS nw FROM L {W}),
i AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING)::INT AS run FROM s)
SELECT doc_id, run, string_agg(text, ' ' ORDER BY pdf_idx) AS text, count(*) AS n, min(line_x0) AS x0, max(line_x1) AS x1 FROM i GROUP BY 1, 2""")
def same_line_merge(spark, d):
    """Fragments that stand close merged, text joined, boxes united."""
    s = lines_of(spark, d)
    near = (F.abs(F.col("line_y0") - F.lag("line_y0").over(in_order())) > 14) | (F.col("page") != F.lag("page").over(in_order()))
    s = s.withColumn("run", F.sum(F.coalesce(near.cast("int"), F.lit(1))).over(in_order().rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    text_ = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pdf_idx", "text"))), lambda x: x["text"]), " ")
    return s.groupBy("doc_id", "run").agg(text_.alias("text"), F.count("*").alias("n"), F.min("line_x0").alias("x0"), F.max("line_x1").alias("x1"))


@query(f"""WITH {LINES}, b AS (SELECT doc_id, page, pdf_idx, line_x0 AS x0, line_y0 AS y0, line_x1 AS x1, line_y0 + 16 AS y1 FROM L)
SELECT doc_id, page, pdf_idx FROM b c WHERE NOT EXISTS (SELECT 1 FROM b e WHERE e.doc_id = c.doc_id AND e.page = c.page AND e.pdf_idx < c.pdf_idx
  AND 2.0 * greatest(least(e.x1, c.x1) - greatest(e.x0, c.x0), 0) * greatest(least(e.y1, c.y1) - greatest(e.y0, c.y0), 0) / ((e.x1 - e.x0) * (e.y1 - e.y0) + (c.x1 - c.x0) * (c.y1 - c.y0)) > 0.1)""")
def table_cells(spark, d):
    """S1c, S1d, S1g: boxes that overlap no earlier box of their page; an anti join on (document, page)."""
    box = lines_of(spark, d).select("doc_id", "page", "pdf_idx", F.col("line_x0").alias("x0"), F.col("line_y0").alias("y0"), F.col("line_x1").alias("x1"), (F.col("line_y0") + 16).alias("y1"))
    c, e = box.alias("c"), box.alias("e")
    sides = [tuple(F.col(f"{t}.{k}") for k in ("x0", "y0", "x1", "y1")) for t in "ec"]
    on = (F.col("e.doc_id") == F.col("c.doc_id")) & (F.col("e.page") == F.col("c.page")) & (F.col("e.pdf_idx") < F.col("c.pdf_idx")) & (layout.dice(*sides) > 0.1)
    return c.join(e, on, "left_anti").select("doc_id", "page", "pdf_idx")


@query(f"""WITH {LINES}, t AS (SELECT doc_id, page, list({{'x0': line_x0, 'x1': line_x1, 'y0': line_y0, 'y1': line_y0 + 12}} ORDER BY pdf_idx) AS boxes FROM L WHERE is_table GROUP BY 1, 2)
SELECT L.doc_id, pdf_idx, coalesce(len(list_filter(boxes, lambda b: ((line_x0 > b.x0 AND line_x0 < b.x1) OR (line_x1 > b.x0 AND line_x1 < b.x1)) AND ((line_y0 > b.y0 AND line_y0 < b.y1) OR (line_y0 + 12 > b.y0 AND line_y0 + 12 < b.y1)))) > 0, false) AS in_table
FROM L LEFT JOIN t USING (doc_id, page)""")
def lines_in_tables(spark, d):
    """S1e: a line with an x edge and a y edge strictly inside a table box of its page."""
    lines = lines_of(spark, d)
    boxes = lines.where("is_table").groupBy("doc_id", "page").agg(F.collect_list(F.struct(F.col("line_x0").alias("x0"), F.col("line_x1").alias("x1"), F.col("line_y0").alias("y0"), (F.col("line_y0") + 12).alias("y1"))).alias("boxes"))
    inside = lambda v, lo, hi: (v > lo) & (v < hi)
    x0, x1, y0 = F.col("line_x0"), F.col("line_x1"), F.col("line_y0")
    hit = F.exists("boxes", lambda b: (inside(x0, b["x0"], b["x1"]) | inside(x1, b["x0"], b["x1"])) & (inside(y0, b["y0"], b["y1"]) | inside(y0 + 12, b["y0"], b["y1"])))
    return lines.join(boxes, ["doc_id", "page"], "left").select("doc_id", "pdf_idx", F.coalesce(hit, F.lit(False)).alias("in_table"))


@query(f"""WITH {LINES}, h AS (SELECT doc_id, page, family, sum(length(text))::BIGINT AS n, min(pdf_idx) AS pos FROM L GROUP BY 1, 2, 3)
SELECT doc_id, page, arg_min(family, (-n * 1000000 + pos)) AS major_family, count(*) AS n_families, max(n) AS major_chars FROM h GROUP BY 1, 2""")
def font_histogram(spark, d):
    """S1f, T32: characters by font on a page, the most used one, the first at ties."""
    h = lines_of(spark, d).groupBy("doc_id", "page", "family").agg(F.sum(F.length("text")).alias("n"), F.min("pdf_idx").alias("at"))
    return h.groupBy("doc_id", "page").agg(F.min_by("family", -F.col("n") * 1000000 + F.col("at")).alias("major_family"), F.count("*").alias("n_families"), F.max("n").alias("major_chars"))


@query(f"""WITH {LINES}, c AS (SELECT doc_id, pdf_idx, block_x0, min(block_x0) OVER v AS lo, max(block_x0) OVER v AS hi, 1 + doc_id % 4 AS n FROM L WINDOW v AS (PARTITION BY doc_id, page))
SELECT doc_id, pdf_idx, CASE WHEN n = 1 THEN 0 ELSE len(list_filter(range(n + 1), lambda i: block_x0 > lo + i * (hi - lo) / n::DOUBLE)) END::INT AS col_num FROM c""")
def column_number(spark, d):
    """the first of a page's column lines at or right of a block's left edge, for any number of columns."""
    page = Window.partitionBy("doc_id", "page")
    c = lines_of(spark, d).select("doc_id", "pdf_idx", "block_x0", F.min("block_x0").over(page).alias("lo"), F.max("block_x0").over(page).alias("hi"), (1 + F.col("doc_id") % 4).alias("n"))
    return c.select("doc_id", "pdf_idx", layout.column_number(F.col("block_x0"), F.col("lo"), F.col("hi"), F.col("n")).alias("col_num"))


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, (line_y0 + font_size >= 120 AND length(text) < page_width) OR (page_width > 700 AND line_y0 + font_size >= 110) AS is_footnote, line_y0 + 6 < 80 AS in_top_margin FROM L""")
def footnote_test(spark, d):
    """L3, L1 (flags): margins as plain columns once the margins are known."""
    low = F.col("line_y0") + F.col("font_size")
    test = ((low >= 120) & (F.length("text") < F.col("page_width"))) | ((F.col("page_width") > 700) & (low >= 110))
    return lines_of(spark, d).select("doc_id", "pdf_idx", test.alias("is_footnote"), (F.col("line_y0") + 6 < 80).alias("in_top_margin"))


@query(f"""WITH {LINES}, p AS (SELECT doc_id, pdf_idx, CASE WHEN pdf_idx % 4 = 1 THEN page END AS seen FROM L)
SELECT doc_id, pdf_idx, last_value(seen IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pdf_idx ROWS UNBOUNDED PRECEDING) AS page_filled FROM p""")
def page_fill(spark, d):
    """S5f: as-of fill of page marks forward."""
    seen = F.when(F.col("pdf_idx") % 4 == 1, F.col("page"))
    return lines_of(spark, d).select("doc_id", "pdf_idx", F.last(seen, ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, 0)).alias("page_filled"))


@query(f"""WITH {LINES}, k AS (SELECT doc_id, pdf_idx, text, (pdf_idx % 5) AS k FROM L),
s AS (SELECT *, lead(text, 1) OVER w AS t1, lead(text, 2) OVER w AS t2, lead(k, 1) OVER w AS k1, lead(k, 2) OVER w AS k2, lag(k, 1) OVER w AS b1, lag(k, 2) OVER w AS b2 FROM k {W})
SELECT doc_id, pdf_idx, CASE WHEN k = 0 AND k1 = 1 AND k2 = 2 THEN text || ' ' || t1 || ' ' || t2 WHEN k = 3 AND k1 = 4 THEN text || ' ' || t1 ELSE text END AS text
FROM s WHERE NOT (k = 1 AND b1 = 0 AND coalesce(k1 = 2, false)) AND NOT (k = 2 AND b1 = 1 AND coalesce(b2 = 0, false)) AND NOT (k = 4 AND b1 = 3)""")
def stitch_rows(spark, d):
    """Rows stitched with the one or two after them, which are then dropped."""
    s = lines_of(spark, d).select("doc_id", "pdf_idx", "text", (F.col("pdf_idx") % 5).alias("k"))
    at = lambda c, n: (F.lead(c, n) if n > 0 else F.lag(c, -n)).over(in_order())
    s = s.withColumns({"t1": at("text", 1), "t2": at("text", 2), "k1": at("k", 1), "k2": at("k", 2), "b1": at("k", -1), "b2": at("k", -2)})
    s = s.where("not (k = 1 and b1 = 0 and coalesce(k1 = 2, false)) and not (k = 2 and b1 = 1 and coalesce(b2 = 0, false)) and not (k = 4 and b1 = 3)")
    out = F.when((F.col("k") == 0) & (F.col("k1") == 1) & (F.col("k2") == 2), F.concat_ws(" ", "text", "t1", "t2")).when((F.col("k") == 3) & (F.col("k1") == 4), F.concat_ws(" ", "text", "t1")).otherwise(F.col("text"))
    return s.select("doc_id", "pdf_idx", out.alias("text"))


@query("""SELECT conv_id, turn, role, coalesce(lag(role) OVER w, role) AS prev_role, coalesce(lead(role) OVER w, role) AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def page_neighbours(spark, d):
    """The neighbour's value, the own one at the edges."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.coalesce(F.lag("role").over(w), "role").alias("prev_role"), F.coalesce(F.lead("role").over(w), "role").alias("next_role"))
