"""Lines to sections, and sections to chunks for summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.operators.folds import fold_documents
from vellum.sources.tables import in_order

HEADING, CONTENTS = (2, 3), 4
GLOSSARY = ("glossary", "acronyms", "definitions", "references", "abbreviations")
EXECUTIVE = ("executive summary", "abstract", "key takeaways")


def sections(lines: DataFrame, cls: str = "predicted", late: float = 0.1) -> DataFrame:
    """(doc_id, section, heading, content, n_lines): runs of headings joined by " - ", and what follows them.

    Lines up to the last contents entry past a share of the pages are left out; earlier contents entries only end a
    section. What comes before any heading is the introduction."""
    doc = Window.partitionBy("doc_id")
    df = lines.withColumn("_toc", F.col(cls) == CONTENTS)
    reset = F.max(F.when(F.col("_toc") & (F.col("page") > late * F.max("page").over(doc)), F.col("pdf_idx"))).over(doc)
    df = df.withColumn("_reset", reset).where("_reset is null or pdf_idx > _reset")
    df = df.withColumn("_head", F.col(cls).isin(*HEADING))
    before = F.lag(F.when(F.col("_head"), 1).when(F.col("_toc"), 2).otherwise(0)).over(in_order())
    starts = (F.col("_head") & ~F.coalesce(before == 1, F.lit(False))) | (F.coalesce(before == 2, F.lit(False)) & ~F.col("_head"))
    df = df.withColumn("section", F.sum(F.coalesce(starts.cast("int"), F.lit(0))).over(in_order().rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct("pdf_idx", "text", "_head")))
    joined = lambda test, by: F.array_join(F.transform(F.filter("_l", test), lambda x: x["text"]), by)
    g = df.where("not _toc").groupBy("doc_id", "section").agg(rows.alias("_l"), F.count("*").alias("n_lines"))
    heading = joined(lambda x: x["_head"], " - ")
    return g.select("doc_id", "section", F.when(heading == "", "Introduction").otherwise(heading).alias("heading"), joined(lambda x: ~x["_head"], " ").alias("content"), "n_lines")


def wanted(s: DataFrame) -> DataFrame:
    """Only executive sections where a document has any; no glossaries, nothing shorter than its heading."""
    low = F.lower("heading")
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))
    s = s.withColumn("_e", any_of(EXECUTIVE))
    s = s.withColumn("_any", F.max("_e").over(Window.partitionBy("doc_id")))
    return s.where(F.col("_e") | ~F.col("_any")).where(~any_of(GLOSSARY) & (F.length("content") >= F.length("heading"))).drop("_e", "_any")


def chunks(s: DataFrame, least: int = 20, most: int = 200, calls: int = 50) -> DataFrame:
    """(doc_id, chunk, headings, words): sections packed in order up to a budget of words; small chunks are dropped.

    The fold is sequential, so a document is packed in one place."""

    def fold(doc, _, headings: list[str], words: list[int]) -> list[tuple]:
        budget = max(3 * most, int(sum(words)) // calls)
        out, names, size = [], [], 0
        for name, n in zip(headings, words):
            if names and size + n > budget:
                out.append((names, size))
                names, size = [], 0
            if name not in names:
                names = [*names, name]
            size += int(n)
        out.append((names, size))
        return [(doc, i, " | ".join(x), n) for i, (x, n) in enumerate(y for y in out if y[1] > least)]

    sized = s.select("doc_id", "section", "heading", F.regexp_count("content", F.lit("[^ ]+")).alias("words"))
    return fold_documents(sized, "doc_id", "section", ["heading", "words"], fold, "doc_id long, chunk int, headings string, words long")


def extractive_summary(s: DataFrame, sentences: int = 2) -> DataFrame:
    """A stand-in for a language model: the first sentences of each section, joined."""
    first = F.array_join(F.slice(F.split("content", r"(?<=[.!?]) "), 1, sentences), " ")
    parts = s.select("doc_id", "section", F.concat_ws(": ", "heading", first).alias("t"))
    ordered = F.sort_array(F.collect_list(F.struct("section", "t")))
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "\n").alias("summary"))
