"""Helpers of the operators in this package: tables in the shared folder, distributed union-find, shipping code.

Nothing here gathers rows on the driver. Lineage is cut by writing Parquet tables under the folder that
``spark.checkpoint.dir`` names, which every executor can read again after another one is lost.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words in every contract of this package: space, tab, line feed, vertical tab, form feed, return.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"
#: Rows of a batch that Python workers get.
BATCH = 1_000
_own_folder: list[str] = []
_written: list[tuple[SparkSession, str]] = []


def ship(module) -> None:
    """Send the module's functions to the executors by value, so that they need no copy of this package."""
    cloudpickle.register_pickle_by_value(module)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session; a folder of our own only where the session names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="vellum-shared-"))
    return _own_folder[0]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has gone, and its shared folder is the cluster's to clean
            return


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get BATCH rows at a time while a table is written, unless the session asks for fewer: a batch of
    long texts is held outside of the heap by Spark and again by the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= BATCH:
        yield
        return
    spark.conf.set(name, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Table:
    """A DataFrame written to the shared folder. ``drop()`` removes it once nothing reads it any more."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        with _small_batches(self.spark):
            df.write.parquet(self.path)
        _written.append((self.spark, self.path))
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        _delete(self.spark, self.path)
        _written.remove((self.spark, self.path))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    return Table(df, name).df


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Union-find by graph contraction over undirected edges of longs: one row (node, component) for each node.

    ``component`` is some node's number, mixed; callers aggregate what they need for each component.
    Each round hooks every node on its smallest neighbour (smallest by a mixed number, so that a chain in id
    order also shrinks by a constant factor), jumps one pointer, and rewrites the edges between what is left.
    A hub costs nothing extra: minima are combined before the shuffle, and both sides of every join come from
    stored tables, so that a skewed join can be split. Rounds end when no edge is left.
    """
    mixed = Table(edges.select(F.xxhash64(F.col(a)).alias("u"), F.xxhash64(F.col(b)).alias("v")).where("u != v").distinct(), "edges")
    names = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b))).distinct()
    live, levels = mixed, []
    while not is_empty(live.df):
        e = live.df
        both = e.union(e.select("v", "u"))
        near = Table(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("n"), F.least("u", "v").alias("p")), "near")
        q = near.df.select(F.col("n").alias("p"), F.col("p").alias("pp"))
        hooked = Table(near.df.join(q, "p").select("n", F.col("pp").alias("p")), "hooked")
        of_u, of_v = (hooked.df.select(F.col("n").alias(x), F.col("p").alias("p" + x)) for x in "uv")
        pairs = e.join(of_u, "u").join(of_v, "v").where("pu != pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
        left = Table(pairs.distinct(), "edges")
        levels.append(hooked)
        near.drop()
        live.drop()
        live = left
    live.drop()
    labels = names.select("node", F.xxhash64("node").alias("p"))
    for level in levels:
        labels = labels.join(level.df.select(F.col("n").alias("p"), F.col("p").alias("up")), "p", "left").select("node", F.coalesce("up", "p").alias("p"))
    return labels.select("node", F.col("p").alias("component"))
