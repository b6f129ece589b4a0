"""Stage tables in the session's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; in a folder of our own only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="vellum-"))
        folder = _own[0]
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, overwrite: bool = False, by: str | None = None) -> DataFrame:
    """Write a stage's table unless it is there already, and read it: stages that ran are skipped."""
    w = df.write.mode("overwrite" if overwrite else "ignore")
    (w.partitionBy(by) if by else w).parquet(path)
    return df.sparkSession.read.parquet(path)
