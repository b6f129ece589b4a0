"""Tables, and the line table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from vellum.functions.text import BLANKS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_order() -> WindowSpec:
    """Order of a document's lines; everything that looks at neighbours uses it, so one sort serves all."""
    return Window.partitionBy("doc_id").orderBy("pdf_idx")


def line_table(docs: DataFrame) -> DataFrame:
    """One row a line that is not blank, right-trimmed, with a dense index in its document.

    Tables of text have no layout: page, coordinates, fonts and the two class columns are stated integer functions
    of document and line numbers, so that layout operators have deterministic input."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "raw"))
    lines = lines.select("doc_id", "ln", F.rtrim("raw", F.lit(BLANKS)).alias("text")).where("text != ''")
    lines = lines.withColumn("pdf_idx", F.row_number().over(Window.partitionBy("doc_id").orderBy("ln")) - 1)
    kind = (F.col("doc_id") * 3 + F.col("ln") * 5 + F.length("text")) % 10
    predicted = F.get(F.array(*map(F.lit, (2, 3, 0, 0, 1, 1, 1, 4, 0, 1))), kind.cast("int"))
    return lines.select(
        "doc_id", "ln", "pdf_idx", "text",
        F.expr("cast(ln div 5 as int)").alias("page"),
        (72 + 9 * ((F.col("doc_id") + F.col("ln")) % 3)).cast("int").alias("line_x0"),
        (72 + 9 * ((F.col("doc_id") + F.col("ln")) % 3) + 5 * F.least(F.length("text"), F.lit(90))).cast("int").alias("line_x1"),
        (72 + 14 * (F.col("ln") % 5) + F.col("doc_id") % 3 * (F.col("ln") % 2)).cast("int").alias("line_y0"),
        (72 + 200 * (F.col("ln") % 2)).cast("int").alias("block_x0"), F.lit(540).alias("block_x1"), F.lit(612).alias("page_width"),
        (1 + F.col("doc_id") % 2).cast("int").alias("ncols"),
        (10 + (F.col("doc_id") * 7 + F.expr("ln div 3")) % 4).cast("int").alias("font_size"),
        F.when((F.col("doc_id") + F.col("ln")) % 11 == 0, "Arial-Bold").otherwise("Arial").alias("family"),
        predicted.alias("predicted"),
        F.when((F.col("doc_id") + F.col("ln")) % 7 == 0, (predicted + 1) % 5).otherwise(predicted).alias("labelled"),
        ((F.col("doc_id") + F.col("ln")) % 19 == 0).alias("is_table"), ((F.col("doc_id") + F.col("ln")) % 17 == 0).alias("is_header"), ((F.col("doc_id") + F.col("ln")) % 13 == 0).alias("is_footer"),
    )


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_table(table(spark, sf_dir, "documents"))


#: The same as a common table expression named L.
LINES = r"""
L AS (SELECT doc_id, ln, row_number() OVER (PARTITION BY doc_id ORDER BY ln)::INT - 1 AS pdf_idx, text, (ln // 5)::INT AS page,
  (72 + 9 * ((doc_id + ln) % 3))::INT AS line_x0, (72 + 9 * ((doc_id + ln) % 3) + 5 * least(length(text), 90))::INT AS line_x1,
  (72 + 14 * (ln % 5) + doc_id % 3 * (ln % 2))::INT AS line_y0, (72 + 200 * (ln % 2))::INT AS block_x0, 540 AS block_x1, 612 AS page_width,
  (1 + doc_id % 2)::INT AS ncols, (10 + (doc_id * 7 + ln // 3) % 4)::INT AS font_size,
  CASE WHEN (doc_id + ln) % 11 = 0 THEN 'Arial-Bold' ELSE 'Arial' END AS family, p AS predicted,
  CASE WHEN (doc_id + ln) % 7 = 0 THEN (p + 1) % 5 ELSE p END AS labelled,
  (doc_id + ln) % 19 = 0 AS is_table, (doc_id + ln) % 17 = 0 AS is_header, (doc_id + ln) % 13 = 0 AS is_footer
 FROM (SELECT *, ([2, 3, 0, 0, 1, 1, 1, 4, 0, 1]::INT[])[1 + (doc_id * 3 + ln * 5 + length(text)) % 10] AS p FROM (
  SELECT doc_id, ln, regexp_replace(raw, '[ \t\r\n\f\x0B]+$', '') AS text FROM (
   SELECT doc_id, unnest(range(len(a)))::INT AS ln, unnest(a) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))) WHERE text <> ''))
"""
