"""Repair of line classes by neighbour rules, and merging of lines into paragraphs."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.operators.folds import fold_documents
from vellum.functions.text import stripped, words
from vellum.schema import CONTINUATIONS, PAIRS, PREDICTED, lookup
from vellum.sources.tables import in_order

# Headings known by their text, and the forms of bullets and numbered items.
KNOWN_HEADINGS = ("table of contents", "list of figures", "list of tables", "contents")
BULLET = r"^(\[#\w+;\]|[#•]+\s)"
ENUM = r"^(\d+\.\s|\(\d+\)\s|\([a-z]\)\s|[a-z]\.\s)"


def repair(lines: DataFrame, cls: str = "predicted", font: str = "font_size", out: str = "final") -> DataFrame:
    """Rule-based repair of predicted classes. All passes share one order, so rows are dealt and sorted once.

    Classes that no model predicts pass through. The classes of the neighbours are taken once, after the rules on
    single lines; only the last five passes look at the repaired line before."""
    lines = lines.withColumn("_mine", F.coalesce(F.col(cls).isin(*PREDICTED), F.lit(False)))
    order = Window.partitionBy("doc_id", "_mine").orderBy("pdf_idx")  # other classes are no neighbours of these
    w, text, c = words(F.col("text")), F.col("text"), F.col(out)
    contents = (F.size(w) >= 3) & F.get(w, F.lit(0)).rlike(r"^\p{Nd}+$") & F.element_at(w, -1).rlike(r"^\p{Nd}+$")
    dots = F.replace(text, F.lit(" "), F.lit("")).rlike(r"\.{5,}")
    df = lines.withColumn(out, F.when(~F.col("_mine"), F.col(cls)).when(dots | F.coalesce(contents, F.lit(False)), 4).when(F.lower(text).isin(*KNOWN_HEADINGS), 2).otherwise(F.col(cls)))
    df = df.withColumns({"_p": F.lag(out).over(order), "_n": F.lead(out).over(order), "_f": F.lag(font).over(order), "_page": F.lead("page").over(order)})
    p, n = F.col("_p"), F.col("_n")
    marked = stripped(text)
    paragraph = c.isin(0, 1)
    near = lambda *codes: F.coalesce(p.isin(*codes), F.lit(False)) | F.coalesce(n.isin(*codes), F.lit(False))
    rules: list[tuple[Column, int]] = [
        (~c.isin(4, 2) & (p == 4) & (n == 4), 4),
        ((c == 3) & ~F.col(font).eqNullSafe(F.col("_f")), 2),
        ((p == 2) & (c != 2) & (n == 3), 3),
        ((c == 3) & ~F.col("page").eqNullSafe(F.col("_page")), 2),
        ((p == 3) & (n == 0) & (c == 1), 3),
        ((p == 3) & (n == 1) & (c == 1), 0),
        (marked.startswith("[#x2014;]") | marked.startswith("[#x2022;]"), 10),
        (paragraph & near(10, 13) & text.rlike(BULLET), 10),
        (paragraph & near(11, 14) & text.rlike(ENUM), 11),
        ((c == 10) & ~text.rlike(BULLET), 0),
    ]
    for test, to in rules:
        df = df.withColumn(out, F.when(F.col("_mine") & test, to).otherwise(c))
    follow = lookup(p, dict(PAIRS))
    for base, cont in PAIRS:
        df = df.withColumn("_q", F.lag(out).over(order))
        orphan = F.col("_mine") & (c == cont) & ~F.col("_q").eqNullSafe(F.lit(base)) & ~F.col("_q").eqNullSafe(F.lit(cont))
        df = df.withColumn(out, F.when(orphan, F.coalesce(follow, c)).otherwise(c))
    return df.drop("_p", "_n", "_f", "_page", "_q", "_mine").withColumn(out, F.col(out).cast("int"))


def older_classes(classes: list[int]) -> list[int]:
    """The older rules over a document's classes in order. Each line sees the class before it as it has been set, and
    the one after it as it came; the last line only loses a continuation without a heading."""
    out: list[int] = []
    for i, c in enumerate(classes):
        before, last = (out[-1] if out else None), i + 1 == len(classes)
        after = None if last else classes[i + 1]
        if c == 3 and before not in (2, 3):
            c = 2
        elif before is not None and not last:
            if before == 4 and after == 4 and c != 2:
                c = 4
            elif before in (2, 3) and c == 1:
                c = {1: 0, 0: 3}.get(after, c)
        out.append(c)
    return out


def older_rules(lines: DataFrame) -> DataFrame:
    """(doc_id, pdf_idx, cls): older_classes of each document; lines: (doc_id, pdf_idx, cls)."""

    def run(doc, idx: list[int], classes: list[int]) -> list[tuple]:
        return [(doc, i, c) for i, c in zip(idx, older_classes(classes))]

    kinds = dict(lines.dtypes)
    known = lines.select("doc_id", "pdf_idx", F.col("cls").cast("int").alias("cls"))
    return fold_documents(known, "doc_id", "pdf_idx", ["cls"], run, f"doc_id {kinds['doc_id']}, pdf_idx {kinds['pdf_idx']}, cls int")


def carry_list_kind(lines: DataFrame, cls: str, out: str) -> DataFrame:
    """General list continuations take the kind of the last list item before them; bullets at first."""
    seen = F.last(F.when(F.col(cls).isin(10, 11), F.col(cls)), ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    kind = F.when(F.coalesce(seen, F.lit(10)) == 11, 14).otherwise(13)
    return lines.withColumn(out, F.when(F.col(cls) == 12, kind).otherwise(F.col(cls)))


def merge_lines(lines: DataFrame, cls: str) -> DataFrame:
    """Paragraphs of lines: a base line and the continuations after it on its page and column.

    A continuation that starts a page or column is made a base; one with nothing before it is dropped. Headers,
    footers and footnotes stand for themselves and do not end a paragraph; lines without a class are dropped. All is one
    pass: the lines of a document are dealt once, and sorted once for the flow and once for its paragraphs."""
    edge = ~(F.col("page").eqNullSafe(F.lag("page").over(in_order())) & F.col("ncols").eqNullSafe(F.lag("ncols").over(in_order())))
    df = lines.withColumns({"_margin": F.col(cls).isin(6, 7, 8), "_edge": edge}).where(F.col(cls).isNotNull())
    cont = F.col(cls).isin(*CONTINUATIONS)
    base = F.col(cls).isin(*(b for b, _ in PAIRS)) | (cont & F.col("_edge"))
    kind = lookup(F.col(cls).cast("int"), {1: 0, 3: 2, 13: 10, 14: 11})
    df = df.withColumns({"_starts": base | ~cont | F.col("_edge"), "_base": base, "_cont": cont, "_cls": F.when(~F.col("_margin") & cont & F.col("_edge"), kind).otherwise(F.col(cls))})
    flow = Window.partitionBy("doc_id", "_margin").orderBy("pdf_idx").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_gid", F.when(F.col("_margin"), -1 - F.col("pdf_idx")).otherwise(F.sum(F.col("_starts").cast("int")).over(flow)))
    within = Window.partitionBy("doc_id", "_gid").orderBy("pdf_idx")
    df = df.withColumns({"_open": F.first("_base").over(within), "_at": F.row_number().over(within)})
    df = df.where(F.col("_margin") | ((F.col("_at") == 1) & ~(F.col("_cont") & ~F.col("_base"))) | ((F.col("_at") > 1) & F.col("_open")))
    ordered = F.sort_array(F.collect_list(F.struct("pdf_idx", "text", "_cls", "page")))
    boxes = [F.min("line_x0").alias("line_x0"), F.min("line_y0").alias("line_y0"), F.max("line_x1").alias("line_x1")]
    merged = df.groupBy("doc_id", "_gid").agg(ordered.alias("_l"), *boxes)
    first = F.get("_l", F.lit(0))
    joined = F.array_join(F.transform("_l", lambda x: x["text"]), "")
    return merged.select("doc_id", first["pdf_idx"].alias("pdf_idx"), first["_cls"].cast("int").alias("cls"), first["page"].alias("page"), joined.alias("text"), F.size("_l").alias("n_lines"), "line_x0", "line_y0", "line_x1")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
