"""Parts of long texts."""

import duckdb

from vellum.plans import QUERIES, SQL


def test_words_are_split_once_for_all_parts(spark, tmp_path):
    texts = [None, "", " \t\n", "one", " a\x0bb c  d\r\n", " ".join(map(str, range(256))), " ".join(map(str, range(257))) + "\n", " \n".join(map(str, range(100_000)))]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["chunk_128"](spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("split(") == 1
    c = duckdb.connect()
    c.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, df.collect())) == sorted(c.sql(SQL["chunk_128"]).fetchall())
