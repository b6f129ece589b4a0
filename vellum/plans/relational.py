"""Queries of joins, aggregations, evaluation, sorts, sets and reshaping."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellum.plans.registry import query
from vellum.schema import CLASSES, class_name, lookup
from vellum.sources.tables import LINES, lines_of, table

# Classes folded for training, and list classes folded for evaluation.
FOLDED = {13: 1, 14: 1, 12: 1, 10: 0, 11: 0}
FOLD_SQL = "CASE {0} WHEN 13 THEN 1 WHEN 14 THEN 1 WHEN 12 THEN 1 WHEN 10 THEN 0 WHEN 11 THEN 0 ELSE {0} END"


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, predicted AS predicted_class, labelled AS labelled_class FROM L WHERE predicted IS DISTINCT FROM labelled")
def label_diff(spark, d):
    """Two frames joined on the line, rows whose classes differ."""
    lines = lines_of(spark, d)
    a = lines.select("doc_id", "pdf_idx", F.col("predicted").alias("predicted_class"))
    b = lines.select("doc_id", "pdf_idx", F.col("labelled").alias("labelled_class"))
    return a.join(b, ["doc_id", "pdf_idx"], "left").where(~F.col("predicted_class").eqNullSafe(F.col("labelled_class")))


@query("""WITH o AS (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders)
SELECT c_custkey, c_mktsegment, o_orderstatus AS last_status FROM customer JOIN o ON c_custkey = o_custkey AND r = 1""")
def lookup_join(spark, d):
    """Inner lookup in a map where the last duplicate wins."""
    last = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("last_status"))
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(last, "c_custkey")


@query("""WITH m AS (SELECT o_orderkey, l_linenumber, l_shipdate::DATE AS shipped, o_orderdate::DATE AS ordered, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_shipdate) AS r FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT o_orderkey, l_linenumber, date_diff('day', ordered, shipped)::INT AS days FROM m WHERE r = 1 AND ordered <> shipped""")
def first_match_diff(spark, d):
    """The first match of each row, where it differs."""
    first = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_shipdate")).alias("x"))
    m = table(spark, d, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"))
    days = F.datediff(F.col("x.l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return m.select("o_orderkey", F.col("x.l_linenumber").alias("l_linenumber"), days.alias("days")).where("days != 0")


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, CASE WHEN pdf_idx % 3 = 0 THEN font_size + 1 ELSE font_size END AS font_size, CASE WHEN pdf_idx % 3 = 0 THEN labelled END AS added FROM L""")
def update_features(spark, d):
    """Rows with a new version take all of its columns, also null ones; missing columns are made."""
    lines = lines_of(spark, d)
    new = lines.where("pdf_idx % 3 = 0").select("doc_id", "pdf_idx", (F.col("font_size") + 1).alias("new_size"), F.col("labelled").alias("added"), F.lit(True).alias("matched"))
    joined = lines.select("doc_id", "pdf_idx", "font_size").join(new, ["doc_id", "pdf_idx"], "left")
    return joined.select("doc_id", "pdf_idx", F.when(F.col("matched"), F.col("new_size")).otherwise(F.col("font_size")).alias("font_size"), "added")


@query("""WITH r AS (SELECT o_custkey AS k, max(o_orderdate) AS stored FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), s AS (SELECT o_custkey AS k, max(o_orderdate) AS incoming FROM orders GROUP BY 1)
SELECT s.k, (stored IS NULL) AS is_new FROM s LEFT JOIN r USING (k) WHERE stored IS NULL OR stored < incoming""")
def newer_files(spark, d):
    """What is new, or newer than what is stored."""
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    stored = o.where("o_orderkey % 2 = 0").groupBy("k").agg(F.max("o_orderdate").alias("stored"))
    return o.groupBy("k").agg(F.max("o_orderdate").alias("incoming")).join(stored, "k", "left").where("stored is null or stored < incoming").select("k", F.col("stored").isNull().alias("is_new"))


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def two_hop_lookup(spark, d):
    """A lookup through two tables; Spark broadcasts the small ones by their size."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return s.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", "n_name", "r_name")


_PIECES = f"""{LINES}, src AS (SELECT doc_id, page, string_agg(text, ' ' ORDER BY pdf_idx) AS source, count(*) AS n_source FROM L GROUP BY 1, 2),
 hit AS (SELECT doc_id, page, string_agg(text, ' ' ORDER BY pdf_idx) AS matched, sum(len(regexp_extract_all(text, '[^ ]+')))::BIGINT AS words FROM L WHERE labelled = predicted GROUP BY 1, 2)"""


@query(f"""WITH {_PIECES} SELECT doc_id, page, coalesce(matched, '') AS matched, round(100.0 * coalesce(words, 0) / len(regexp_extract_all(source, '[^ ]+')), 6) AS word_percent FROM src LEFT JOIN hit USING (doc_id, page)""")
def gather_source(spark, d):
    """Each source block with its matched lines in order, and the share of words found."""
    lines = lines_of(spark, d)
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pdf_idx", "text"))), lambda x: x["text"]), " ").alias(c)
    n_words = F.regexp_count("text", F.lit("[^ ]+"))
    src = lines.groupBy("doc_id", "page").agg(F.sum(n_words).alias("n"))
    hit = lines.where("labelled = predicted").groupBy("doc_id", "page").agg(joined("matched"), F.sum(n_words).alias("words"))
    return src.join(hit, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce("matched", F.lit("")).alias("matched"), F.round(100.0 * F.coalesce("words", F.lit(0)) / F.col("n"), 6).alias("word_percent"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def unused_source(spark, d):
    """Source rows without any match."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("""WITH m AS (SELECT p_partkey, any_value(p_name) AS p_name, sum(l_quantity) AS used, any_value(p_size) AS p_size FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1)
SELECT p_partkey, used, p_size FROM m WHERE used < p_size * 30""")
def short_covered(spark, d):
    """Rows covered less than their length."""
    used = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("used"))
    return table(spark, d, "part").select("p_partkey", "p_size").join(used, "p_partkey").where(F.col("used") < F.col("p_size") * 30)


_NUM = ("l_quantity", "l_discount", "l_tax")


@query(f"""WITH c AS (SELECT l_returnflag, {", ".join(f"avg({c}) AS {c}" for c in _NUM)} FROM lineitem GROUP BY 1), u AS (UNPIVOT c ON {", ".join(_NUM)} INTO NAME feature VALUE mean)
SELECT l_orderkey, l_linenumber, arg_min(u.l_returnflag, struct_pack(a := round(abs(mean - x.l_quantity), 9), b := u.l_returnflag)) AS nearest FROM lineitem x JOIN u ON feature = 'l_quantity' GROUP BY 1, 2""")
def nearest_centroid(spark, d):
    """Class means unpivoted, the nearest class of a row."""
    li = table(spark, d, "lineitem")
    means = li.groupBy("l_returnflag").agg(*(F.avg(c).alias(c) for c in _NUM)).unpivot(["l_returnflag"], list(_NUM), "feature", "mean")
    x = li.select("l_orderkey", "l_linenumber", "l_quantity", F.lit("l_quantity").alias("feature"))
    return x.join(means, "feature").groupBy("l_orderkey", "l_linenumber").agg(F.min_by("l_returnflag", F.struct(F.round(F.abs(F.col("mean") - F.col("l_quantity")), 9), "l_returnflag")).alias("nearest"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def id_list_filter(spark, d):
    """Rows whose id is in another table's ids."""
    ids = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(ids, "o_custkey", "left_semi").select("o_orderkey", "o_orderstatus")


# --- evaluation -----------------------------------------------------------------------------------------------------

_CLASSES = list(CLASSES.items())[:13]
_DIM = ", ".join(f"({v}, '{k}')" for k, v in _CLASSES)
_BASE_SQL = "CASE {0} WHEN 1 THEN 0 WHEN 3 THEN 2 WHEN 13 THEN 10 WHEN 14 THEN 11 ELSE {0} END"
_METRICS = f"""WITH {LINES}, dim AS (SELECT * FROM (VALUES {_DIM}) v(cls, name)), w AS (SELECT *, len(regexp_extract_all(text, '[^ ]+')) AS n FROM L),
 a AS (SELECT labelled AS cls, count(*) AS source_records FROM L GROUP BY 1), b AS (SELECT predicted AS cls, count(*) AS pdf_records FROM L GROUP BY 1),
 s AS (SELECT {_BASE_SQL.format("labelled")} AS cls, sum(n)::BIGINT AS source_words FROM w GROUP BY 1), p AS (SELECT {_BASE_SQL.format("predicted")} AS cls, sum(n)::BIGINT AS pdf_words FROM w GROUP BY 1),
 m AS (SELECT cls, name, coalesce(source_records, 0)::BIGINT AS source_records, coalesce(pdf_records, 0)::BIGINT AS pdf_records, coalesce(source_words, 0)::BIGINT AS source_words, coalesce(pdf_words, 0)::BIGINT AS pdf_words
  FROM dim LEFT JOIN a USING (cls) LEFT JOIN b USING (cls) LEFT JOIN s USING (cls) LEFT JOIN p USING (cls))"""


@query(f"{_METRICS} SELECT *, round(pdf_words / nullif(source_words, 0)::DOUBLE, 6) AS word_ratio, round(pdf_records / nullif(source_records, 0)::DOUBLE, 6) AS record_ratio FROM m")
def class_metrics(spark, d):
    """Records and words for each of the fixed classes, also absent ones; ratios null without a base."""
    lines = lines_of(spark, d)
    dim = spark.createDataFrame([(v, k) for k, v in _CLASSES], "cls int, name string")
    n = F.regexp_count("text", F.lit("[^ ]+"))
    base = lambda c: F.coalesce(lookup(F.col(c), {1: 0, 3: 2, 13: 10, 14: 11}), F.col(c))
    out = dim
    for c, records, words in (("labelled", "source_records", "source_words"), ("predicted", "pdf_records", "pdf_words")):
        out = out.join(lines.groupBy(F.col(c).alias("cls")).agg(F.count("*").alias(records)), "cls", "left")
        out = out.join(lines.groupBy(base(c).alias("cls")).agg(F.sum(n).alias(words)), "cls", "left")
    out = out.fillna(0)
    ratio = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 6)
    return out.withColumns({"word_ratio": ratio("pdf_words", "source_words"), "record_ratio": ratio("pdf_records", "source_records")})


@query(f"{_METRICS} SELECT sum(source_records)::BIGINT AS source_records, sum(pdf_records)::BIGINT AS pdf_records, sum(source_words)::BIGINT AS source_words, sum(pdf_words)::BIGINT AS pdf_words FROM m")
def metric_totals(spark, d):
    """Totals of the metrics."""
    return class_metrics(spark, d).agg(*(F.sum(c).cast("long").alias(c) for c in ("source_records", "pdf_records", "source_words", "pdf_words")))


@query(f"""WITH {LINES} SELECT labelled, {", ".join(f"count(*) FILTER (predicted = {k}) AS p{k}" for k in range(5))} FROM L GROUP BY 1""")
def confusion_matrix(spark, d):
    """Counts of true by predicted class."""
    m = lines_of(spark, d).groupBy("labelled").pivot("predicted", list(range(5))).agg(F.count(F.lit(1)))
    return m.fillna(0).select("labelled", *(F.col(str(k)).alias(f"p{k}") for k in range(5)))


_PRF = f"""WITH {LINES}, c AS (SELECT labelled AS t, predicted AS p, count(*) AS n FROM L GROUP BY 1, 2), k AS (SELECT DISTINCT x FROM (SELECT t AS x FROM c UNION ALL SELECT p FROM c)),
 s AS (SELECT x AS cls, coalesce((SELECT sum(n) FROM c WHERE t = x AND p = x), 0) AS tp, coalesce((SELECT sum(n) FROM c WHERE p = x), 0) AS pred, coalesce((SELECT sum(n) FROM c WHERE t = x), 0) AS support FROM k),
 f AS (SELECT cls, support::BIGINT AS support, coalesce(tp / nullif(pred, 0)::DOUBLE, 0) AS pr, coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS re FROM s)"""


@query(f"{_PRF} SELECT cls, support, round(pr, 6) AS precision_, round(re, 6) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1 FROM f")
def class_prf(spark, d):
    """Precision, recall and F1 of each class, 0 where undefined."""
    return _prf(spark, d).select("cls", "support", F.round("pr", 6).alias("precision_"), F.round("re", 6).alias("recall"), F.round("f1", 6).alias("f1"))


def _prf(spark, d):
    c = lines_of(spark, d).groupBy("labelled", "predicted").agg(F.count("*").alias("n"))
    both = F.array(F.struct(F.col("labelled").alias("cls"), F.lit(0).alias("side")), F.struct(F.col("predicted").alias("cls"), F.lit(1).alias("side")))
    s = c.withColumn("x", F.explode(both)).groupBy("x.cls").agg(
        F.sum(F.when((F.col("x.side") == 0) & (F.col("labelled") == F.col("predicted")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("x.side") == 1, F.col("n")).otherwise(0)).alias("pred"), F.sum(F.when(F.col("x.side") == 0, F.col("n")).otherwise(0)).alias("support"),
    )
    z = F.lit(0)
    s = s.withColumns({"pr": F.coalesce(F.col("tp") / F.nullif("pred", z), F.lit(0.0)), "re": F.coalesce(F.col("tp") / F.nullif("support", z), F.lit(0.0))})
    return s.withColumn("f1", F.coalesce(2 * F.col("pr") * F.col("re") / F.nullif(F.col("pr") + F.col("re"), F.lit(0.0)), F.lit(0.0)))


@query(f"""{_PRF}, g AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM f) SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(avg(f1), 6) AS macro_f1,
 round(sum(re * support) / sum(support), 6) AS accuracy FROM g""")
def f1_scores(spark, d):
    """Weighted and macro F1, accuracy."""
    w = lambda c: F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), 6)
    return _prf(spark, d).agg(w("f1").alias("weighted_f1"), F.round(F.avg("f1"), 6).alias("macro_f1"), w("re").alias("accuracy"))


@query(f"""WITH {LINES} SELECT labelled, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY labelled), 6) AS row_share FROM L GROUP BY 1, 2""")
def error_analysis(spark, d):
    """Crosstab normalised by row."""
    c = lines_of(spark, d).groupBy("labelled", "predicted").agg(F.count("*").alias("n"))
    return c.withColumn("row_share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("labelled")), 6))


@query(f"""WITH {LINES} SELECT doc_id, count(*) AS n, round(100.0 * sum((labelled <> predicted)::INT) / count(*), 6) AS mismatch_percent FROM L GROUP BY 1""")
def doc_mismatch(spark, d):
    """Share of mismatches of each document."""
    return lines_of(spark, d).groupBy("doc_id").agg(F.count("*").alias("n"), F.round(100.0 * F.sum((F.col("labelled") != F.col("predicted")).cast("int")) / F.count("*"), 6).alias("mismatch_percent"))


@query("""WITH u AS (UNPIVOT (SELECT l_returnflag, l_quantity, l_discount * 100 AS discount FROM lineitem) ON l_quantity, discount INTO NAME feature VALUE v)
SELECT l_returnflag, feature, least(20, greatest(1, floor((v - 0) / 2.5)::INT + 1)) AS bucket, count(*) AS n FROM u GROUP BY 1, 2, 3""")
def histogram(spark, d):
    """Long form of features, counts of 20 bins for each class."""
    u = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_discount") * 100).alias("discount")).unpivot(["l_returnflag"], ["l_quantity", "discount"], "feature", "v")
    bucket = F.least(F.lit(20), F.greatest(F.lit(1), F.floor(F.col("v") / 2.5).cast("int") + 1))
    return u.groupBy("l_returnflag", "feature", bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH {LINES} SELECT doc_id, round(sum(len(regexp_extract_all(text, '(^| )\\p{{Lu}}'))) / sum(len(regexp_extract_all(text, '[^ ]+'))), 6) AS capital_fraction, count(DISTINCT page) AS pages FROM L GROUP BY 1""")
def capital_fraction(spark, d):
    """Share of capitalised words, distinct pages."""
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p)))
    return lines_of(spark, d).groupBy("doc_id").agg(F.round(n(r"(^| )\p{Lu}") / n("[^ ]+"), 6).alias("capital_fraction"), F.countDistinct("page").alias("pages"))


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, predicted, {FOLD_SQL.format('(predicted * 3)')} AS folded FROM L")
def class_folding(spark, d):
    """List classes folded into paragraphs."""
    c = (F.col("predicted") * 3).cast("int")
    return lines_of(spark, d).select("doc_id", "pdf_idx", "predicted", F.coalesce(lookup(c, FOLDED), c).alias("folded"))


@query("""WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, o_orderstatus, (r > floor(0.8 * n)) AS is_test FROM r""")
def stratified_split(spark, d):
    """ML3: the same share of each class, dealt by a hash. Rows are ranked within 4,096 parts of each class; sums of
    the parts before give the rank in the class, so that no sort holds a class."""
    key = F.md5(F.col("o_orderkey").cast("string"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", key.alias("h"), F.substring(key, 1, 3).alias("part"))
    by = Window.partitionBy("o_orderstatus")
    sizes = rows.groupBy("o_orderstatus", "part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("o_orderstatus", "part", before.alias("before"), F.sum("rows").over(by).alias("n"))
    at = F.row_number().over(Window.partitionBy("o_orderstatus", "part").orderBy("h", "o_orderkey"))
    r = rows.withColumn("at", at).join(sizes, ["o_orderstatus", "part"])
    return r.select("o_orderkey", "o_orderstatus", (F.col("before") + F.col("at") > F.floor(0.8 * F.col("n"))).alias("is_test"))


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, [(predicted = 0)::INT, (predicted = 1)::INT, (predicted = 2)::INT, (predicted = 3)::INT, (predicted = 4)::INT]::VARCHAR AS target, predicted IN (0, 2) AS is_first FROM L WHERE labelled IN (0, 1, 2)""")
def one_hot_target(spark, d):
    """ML8, ML9, ML16: five-way target, a split by version."""
    hot = F.concat(F.lit("["), F.array_join(F.array(*((F.col("predicted") == k).cast("string") for k in range(5))), ", "), F.lit("]"))
    hot = F.replace(F.replace(hot, F.lit("true"), F.lit("1")), F.lit("false"), F.lit("0"))
    return lines_of(spark, d).where(F.col("labelled").isin(0, 1, 2)).select("doc_id", "pdf_idx", hot.alias("target"), F.col("predicted").isin(0, 2).alias("is_first"))


@query(f"""WITH {LINES}, t AS (SELECT doc_id, page, max((predicted = 4)::INT) AS toc FROM L GROUP BY 1, 2)
SELECT doc_id, pdf_idx, CASE WHEN font_size > 12 THEN 2 ELSE predicted END AS cls, copy FROM L JOIN t USING (doc_id, page), range(2) r(copy) WHERE toc = 0 OR predicted = 4""")
def toc_pages_oversampled(spark, d):
    """ML12, ML13, ML14: pages with contents keep only those rows; large fonts are headings; rows twice."""
    toc = F.max((F.col("predicted") == 4).cast("int")).over(Window.partitionBy("doc_id", "page"))
    kept = lines_of(spark, d).withColumn("toc", toc).where("toc = 0 or predicted = 4")
    return kept.select("doc_id", "pdf_idx", F.when(F.col("font_size") > 12, 2).otherwise(F.col("predicted")).alias("cls"), F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("copy"))


@query("""SELECT l_returnflag, arg_min(struct_pack(o := l_orderkey, n := l_linenumber), struct_pack(a := round(abs(l_tax - l_discount), 9), b := l_orderkey, c := l_linenumber)).o AS l_orderkey, round(min(abs(l_tax - l_discount)), 6) AS gap FROM lineitem GROUP BY 1""")
def boundary_row(spark, d):
    """ML19, ML17: the row where two scores differ least."""
    gap = F.abs(F.col("l_tax") - F.col("l_discount"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.min_by("l_orderkey", F.struct(F.round(gap, 9), "l_orderkey", "l_linenumber")).alias("l_orderkey"), F.round(F.min(gap), 6).alias("gap"))


# --- sorts, sets, reshape -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10")
def top_with_offset(spark, d):
    """Ordered rows, cut by limit and offset."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(10).limit(50)


@query("SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY abs(l_linenumber - 3), l_linenumber, l_partkey) AS r FROM lineitem) WHERE r <= 2")
def nearest_candidates(spark, d):
    """Candidates by distance to an expected place, cut to a number."""
    by = Window.partitionBy("l_orderkey").orderBy(F.abs(F.col("l_linenumber") - 3), "l_linenumber", "l_partkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.row_number().over(by).alias("r")).where("r <= 2").drop("r")


@query("""SELECT 'customer' AS source_file, c_nationkey::BIGINT AS nation, c_acctbal AS balance, NULL::VARCHAR AS extra FROM customer UNION ALL SELECT 'supplier', s_nationkey, s_acctbal, s_name FROM supplier""")
def union_frames(spark, d):
    """Frames of unlike columns stacked, with their origin."""
    c = table(spark, d, "customer").select(F.lit("customer").alias("source_file"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("source_file"), F.col("s_nationkey").cast("long").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("extra"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1""")
def distinct_keep(spark, d):
    """The first and the last row of each key; aggregation, not a sort of all rows."""
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"))


@query("""WITH g AS (SELECT l_orderkey, list_distinct(list(l_linenumber::INT)) AS seen FROM lineitem GROUP BY 1)
SELECT l_orderkey, list_sort(list_filter(range(1, 8)::INT[], lambda i: NOT list_contains(seen, i)))::VARCHAR AS missing FROM g""")
def missing_numbers(spark, d):
    """O7, S5e: numbers of a range that do not occur."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_linenumber").cast("int")).alias("seen"))
    missing = F.array_join(F.array_sort(F.array_except(F.sequence(F.lit(1), F.lit(7)), "seen")), ", ")
    return g.select("l_orderkey", F.concat(F.lit("["), missing, F.lit("]")).alias("missing"))


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""")
def crosstab(spark, d):
    """Wide form of counts."""
    m = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)
    return m.select("o_orderpriority", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("""SELECT p_partkey, coalesce(nullif(p_name, ''), 'none') AS name, nullif(p_brand, 'Brand#11') AS brand FROM part""")
def null_forms(spark, d):
    """Empty and null made one or the other."""
    return table(spark, d, "part").select("p_partkey", F.coalesce(F.nullif(F.col("p_name"), F.lit("")), F.lit("none")).alias("name"), F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("brand"))


@query(f"""WITH {LINES} SELECT doc_id, pdf_idx, predicted NOT IN (4, 2) OR predicted IS NULL AS kept, {"CASE predicted WHEN 0 THEN 'PARAGRAPH' WHEN 1 THEN 'PARAGRAPH_CONT' WHEN 2 THEN 'HEADING' WHEN 3 THEN 'HEADING_CONT' ELSE 'TOC' END"} AS class_name FROM L""")
def membership(spark, d):
    """Membership with null kept, class names."""
    c = F.col("predicted")
    return lines_of(spark, d).drop("no_such_column").select("doc_id", "pdf_idx", (~c.isin(4, 2) | c.isNull()).alias("kept"), class_name(c).alias("class_name"))


@query("""SELECT s_suppkey, array_position(list_transform([s_acctbal / 10000, s_suppkey % 3 / 2.0, 1.0], lambda x: x > 0.5), true)::BIGINT AS first_page FROM supplier""")
def first_page_over(spark, d):
    """Place of the first value over a half."""
    a = F.array(F.col("s_acctbal") / 10000, F.col("s_suppkey") % 3 / 2.0, F.lit(1.0))
    return table(spark, d, "supplier").select("s_suppkey", F.array_position(F.transform(a, lambda x: x > 0.5), True).alias("first_page"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 6 WHEN o_orderkey % 5 = 0 THEN 7 END AS cls, length(o_orderpriority) > 5 AS valid FROM orders WHERE o_orderpriority LIKE '%-%' AND o_orderdate >= TIMESTAMP '1995-01-01'""")
def pushed_filters(spark, d):
    """Filters that reach the scan, pattern match, validation."""
    o = table(spark, d, "orders").where(F.col("o_orderpriority").like("%-%") & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")))
    k = F.col("o_orderkey")
    return o.select("o_orderkey", F.when(k % 3 == 0, 6).when(k % 5 == 0, 7).alias("cls"), (F.length("o_orderpriority") > 5).alias("valid"))
