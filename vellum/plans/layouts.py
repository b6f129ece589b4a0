"""Queries of rules, boxes, windows, stage tables and saved models."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import models, windows
from vellum.plans.registry import query
from vellum.sources.storage import shared_path, write_stage
from vellum.sources.tables import LINES, lines_of, table

_SEGMENTS = "s AS (SELECT DISTINCT doc_id, page, line_x0 AS x0, line_x0 + 100 * (1 + pdf_idx % 2) - 99 * (pdf_idx % 4 // 3) AS x1, line_y0 AS y0 FROM L)"


@query(f"""WITH {LINES}, {_SEGMENTS} SELECT doc_id, page, x1 - x0 AS length, count(*) AS n_rules, min(y0) AS top, max(y0) AS bottom FROM s WHERE (x1 - x0) * (x1 - x0) >= 10 GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def ruled_tables(spark, d):
    """S2, S2d: short segments and repeats dropped; at least three rules of one length."""
    x1 = F.expr("line_x0 + 100 * (1 + pdf_idx % 2) - 99 * cast(pdf_idx % 4 div 3 as int)")
    s = lines_of(spark, d).select("doc_id", "page", F.col("line_x0").alias("x0"), x1.alias("x1"), F.col("line_y0").alias("y0"), F.col("line_y0").alias("y1"))
    return windows.ruled_tables(s)


@query(f"""WITH {LINES} SELECT doc_id, page, min(line_x0) AS x0, min(line_y0) AS y0, max(line_x1) AS x1, max(line_y0 + 12) AS y1, count(*) AS n FROM L GROUP BY 1, 2""")
def page_boxes(spark, d):
    """S3: the union of a page's boxes."""
    return lines_of(spark, d).groupBy("doc_id", "page").agg(F.min("line_x0").alias("x0"), F.min("line_y0").alias("y0"), F.max("line_x1").alias("x1"), F.max(F.col("line_y0") + 12).alias("y1"), F.count("*").alias("n"))


@query(f"""WITH {LINES}, g AS (SELECT doc_id, page, line_x0, count(*) AS n FROM L GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY n DESC, line_x0) AS r FROM g)
SELECT doc_id, page, max(line_x0) FILTER (r = 1) AS first_x, max(line_x0) FILTER (r = 2) AS second_x, round(coalesce(max(n) FILTER (r = 2) / (max(n) FILTER (r = 1))::DOUBLE, 0), 6) AS balance FROM r WHERE r <= 2 GROUP BY 1, 2""")
def common_edges(spark, d):
    """The two most common left edges of a page and their balance."""
    return windows.common_edges(lines_of(spark, d))


@query(rf"""WITH RECURSIVE {LINES}, c AS (SELECT doc_id, list(len(list_filter(string_split(text, ' '), lambda w: w <> '')) ORDER BY pdf_idx) AS w FROM L GROUP BY 1),
b AS (SELECT doc_id, len(w) AS n, list_transform(range(len(w) + 1), lambda i: coalesce(list_sum(w[1:i]), 0)::BIGINT) AS b FROM c),
r AS (SELECT doc_id, 0 AS win, 0::BIGINT AS s, coalesce(list_filter(range(1, n + 1), lambda e: b[e + 1] >= 200)[1], n) AS e FROM b
 UNION ALL SELECT doc_id, win + 1, t, coalesce(list_filter(range(t + 1, n + 1), lambda e: b[e + 1] - b[t + 1] >= 200)[1], n) FROM (
  SELECT r.doc_id, r.win, b.n, b.b, greatest(r.s + 1, coalesce(list_filter(range(r.s, r.e), lambda i: b.b[r.e + 1] - b.b[i + 1] <= 1)[1], r.e)) AS t FROM r JOIN b USING (doc_id) WHERE r.e < b.n))
SELECT doc_id, win::INT AS window, s::INT AS first_idx, (e - 1)::INT AS last_idx, (b[e + 1] - b[s + 1])::INT AS words FROM r JOIN b USING (doc_id)""")
def sliding_windows(spark, d):
    """Windows of 200 words; the last lines of at most one word together repeat."""
    return windows.sliding_windows(lines_of(spark, d))


@query(f"WITH {LINES} SELECT doc_id, pdf_idx, predicted FROM L")
def stage_table(spark, d):
    """A stage written once, partitioned, skipped when it is there, and read back."""
    path = shared_path(spark, "lines-stage")
    rows = lines_of(spark, d).select("doc_id", "pdf_idx", "predicted")
    write_stage(rows, path, by="predicted")
    return write_stage(rows.limit(0), path, by="predicted").select("doc_id", "pdf_idx", "predicted")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_exchange(spark, d):
    """CSV written and read with a stated schema."""
    path = shared_path(spark, "nation-csv")
    table(spark, d, "nation").write.option("header", True).csv(path)
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").option("header", True).option("enforceSchema", False).csv(path)


@query()
def saved_model(spark, d):
    """A fitted pipeline saved, loaded and applied."""
    from pyspark.ml import PipelineModel

    frame = models.feature_frame(lines_of(spark, d))
    path = shared_path(spark, "model")
    models.fit_forest(frame, trees=5, depth=5).save(path)
    return PipelineModel.load(path).transform(frame).groupBy(F.col("prediction").cast("int").alias("predicted")).agg(F.count("*").alias("n"))


@query()
def loss_curve(spark, d):
    """ML10: accuracy by the number of trees."""
    return models.accuracies(lines_of(spark, d))
