"""Registries of documents: what a scrape changes, and copy-on-write updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reconcile(registry: DataFrame, scraped: DataFrame, key: str = "url") -> DataFrame:
    """One action a key: insert what is new, touch what is there, redownload what is no PDF, report what is missing."""
    r = registry.select(key, F.col("doc").alias("_r"), F.lit(True).alias("_in_r"))
    s = scraped.select(key, F.col("doc").alias("_s"), F.col("is_pdf").alias("_pdf"), F.lit(True).alias("_in_s"))
    action = F.when(F.col("_in_r").isNull(), "insert").when(F.col("_in_s").isNull(), "missing").when(~F.col("_pdf"), "redownload").otherwise("touch")
    return r.join(s, key, "full").select(key, action.alias("action"), F.coalesce("_r", "_s").alias("doc"))


def cancel_stale(registry: DataFrame, reachable: DataFrame, before: int, key: str = "url") -> DataFrame:
    """Active documents last seen before a day and not reachable any more."""
    old = registry.where((F.col("status") == 1) & (F.col("seen") < before))
    return old.join(reachable.select(key), key, "left_anti").select(key, "doc", F.lit(2).alias("status"))


def update(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """df with the values of new where the key is there and the value is not null."""
    columns = [c for c in new.columns if c != key]
    renamed = new.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    return df.join(renamed, key, "left").select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns))


def delete(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def version_actions(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """The newest incoming version of each article, and what to do about it. Aggregation finds the newest."""
    last = incoming.groupBy("pmid").agg(F.max(F.struct("version", "event_id", "body")).alias("x"))
    last = last.select("pmid", F.col("x.version").alias("version"), F.col("x.body").alias("body"))
    action = (
        F.when(F.col("body") == "error", "delete").when(F.col("stored_version").isNull(), "insert").when(F.col("version") > F.col("stored_version"), "update")
        .when((F.col("version") == F.col("stored_version")) & (F.col("body") != F.col("stored_body")), "update_text").otherwise("keep")
    )
    return last.join(stored, "pmid", "left").select("pmid", "version", action.alias("action"))


def running_order(df: DataFrame, key: str, order: str, out: str) -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(order)))


def matching(df: DataFrame, **values) -> DataFrame:
    """Rows that have the given values, all as filters that a scan can take over."""
    return df.where(reduce(lambda a, b: a & b, (F.col(c) == v for c, v in values.items())))
