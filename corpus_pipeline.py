"""Documents to packed training sequences: quality, line dedup, near-dedup, mixing, packing.

Each stage takes the table that the stage before it wrote, works on all of it, and returns the columns of documents,
but for the last, which returns the packed pieces. run() writes each stage's result to the shared folder and reads it
again for the next one.

Every stage takes rows as they come: null and empty texts are kept by lines, near_duplicates (as one group), mixture and
sequences (a piece of the end token), and scored by quality like others. Very long texts are read whole. Rows without
doc_id are scored, mixed and packed like others; lines tells them apart by their text, and near_duplicates keeps all of
them. Rows that share doc_id and text are one row after lines; of groups of near-duplicates the smallest doc_id stays,
and of its rows the one with the smallest hash. A null source is a source of its own. Extra columns of any name and type
stay. An empty table gives no rows. Without labels of both kinds quality keeps all rows, or none if all labels are bad.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import line_classifier, line_dedup, mixing, packing, simhash
from vellum.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier finds good."""
    return line_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines."""
    return line_dedup.dedup_lines(docs, shortest=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask; each at least once."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixture", mixture), ("sequences", sequences)]

#: The classifier, MinHash and the tokenizer are not SQL's; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
