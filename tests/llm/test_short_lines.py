"""Line dedup of the query and of the pipeline's stage on lines too short for MinHash."""

import corpus_pipeline
from vellum.llm import line_dedup


def test_equal_short_lines_go(spark):
    rows = [(1, "short\na line of its own that is long enough\n\n\nShort "), (2, "short\nother"), (3, " SHORT\nother"), (4, "sh0rt\n\n"), (5, None), (6, "\n \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(1, "short\na line of its own that is long enough\n\n"), (2, "other"), (4, "sh0rt\n\n"), (5, None), (6, "\n \n")}
    assert {(r.doc_id, r.text) for r in line_dedup.report(df).collect()} == want
    assert {(r.doc_id, r.text) for r in corpus_pipeline.lines(spark, df, "").collect()} == want
