"""A session with the settings that the engine is planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, partitions: int | None = None, **more: str) -> SparkSession:
    """Settings of the cluster hold where they are given; partitions are for local tests."""
    b = SparkSession.builder.appName("vellum")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in (SETTINGS | more).items():
        b = b.config(k, v)
    return b.getOrCreate()
