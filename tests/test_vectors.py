"""Vector search against brute force."""

import random

from pyspark.sql import functions as F

from vellum.operators import vectors


def test_no_query_is_dropped(spark):
    r = random.Random(5)
    n = vectors.MOST_QUERIES + 100
    of = {i: [round(r.uniform(-1, 1), 3) for _ in range(4)] for i in range(n)}
    df = spark.createDataFrame(list(of.items()), "vec_id long, embedding array<double>").cache()
    best = {}
    for i, x in of.items():
        scored = sorted((-round(sum(a * b for a, b in zip(x, y)), 6), j) for j, y in of.items() if i != j)
        best[i] = [s for s, _ in scored[:2]]
    for found in (vectors.search(df, df, 2), vectors.InvertedLists(df, lists=3).search(df, 2, nprobe=3)):
        got = {}
        for x in sorted(found.collect(), key=lambda x: (x.query_id, x["rank"])):
            got.setdefault(x.query_id, []).append(x.score)
        assert got.keys() == of.keys()
        assert all(len(got[i]) == 2 and max(abs(s + t) for s, t in zip(got[i], best[i])) < 2e-6 for i in of)


def test_recall_of_inverted_lists(spark):
    for sf in ("sf0.01", "sf0.1"):
        e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        q = e.where("vec_id % 100 = 0")
        pairs = [{(r.query_id, r.vec_id) for r in found.collect()} for found in (vectors.search(e, q), vectors.InvertedLists(e).search(q))]
        assert len(pairs[0] & pairs[1]) >= 0.9 * len(pairs[0])


def test_recall_of_codes_and_graphs(spark):
    for sf in ("sf0.01", "sf0.1"):
        e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        q = e.where("vec_id % 100 = 0")
        want = {(r.query_id, r.vec_id) for r in vectors.search(e, q).collect()}
        for index in (vectors.ProductIndex, vectors.InvertedProductIndex, vectors.GraphIndex):
            got = {(r.query_id, r.vec_id) for r in index(e).search(q).collect()}
            assert len(want & got) >= 0.9 * len(want), (sf, index)


def test_codes_cover_all_components(spark):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) for _ in range(7)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    quantizer = vectors.Quantizer(df, parts=3, codes=8)
    assert quantizer.cuts[0][0] == 0 and quantizer.cuts[-1][1] == 7 and all(a[1] == b[0] for a, b in zip(quantizer.cuts, quantizer.cuts[1:]))
    codes = {x.vec_id: x.codes for x in vectors.product_codes(df, parts=3, codes=8).collect()}
    for i, v in rows:
        for p, ((a, b), c) in enumerate(zip(quantizer.cuts, quantizer.centres)):
            d = [sum((x - y) ** 2 for x, y in zip(v[a:b], m)) for m in c.tolist()]
            assert codes[i] == [] or 0 <= codes[i][p] < 8 and min(d) <= d[codes[i][p]]


def test_pages_and_chunks(spark):
    df = spark.range(0, 1_000, 3).withColumnRenamed("id", "vec_id")
    found = [[r.vec_id for r in p.collect()] for p in vectors.pages(df, "vec_id", 100)]
    assert [len(p) for p in found] == [100, 100, 100, 34] and [x for p in found for x in p] == list(range(0, 1_000, 3))
    sizes = vectors.chunks(df, 100).groupBy("chunk").count().collect()
    assert sum(r["count"] for r in sizes) == 334 and max(r["count"] for r in sizes) <= 100


def test_many_queries_are_one_product_and_ties_and_odd_vectors_hold(spark):
    r = random.Random(6)
    of = {i: [r.choice((0.25, 0.5, -0.5, 0.1)) for _ in range(3)] for i in range(1_200)}
    of |= {1_200: None, 1_201: [1.0, None, 1.0], 1_202: [float("inf"), 1.0, 1.0]}
    df = spark.createDataFrame(list(of.items()), "vec_id long, embedding array<float>").repartition(3).cache()
    q = df.where("vec_id < 1100 or vec_id > 1200")
    found = vectors.search(df, q, 4)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in found.collect()}
    q = F.broadcast(q.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_q")))
    pairs = df.join(q, F.col("vec_id") != F.col("query_id")).select("query_id", "vec_id", F.round(vectors.dot(F.col("embedding"), F.col("_q")), 6).alias("score"))
    want = vectors._best(pairs, 4).collect()
    assert len(want) == len(got) == 4 * 1_102 and all(str(got[x.query_id, x["rank"]]) == str((x.vec_id, x.score)) for x in want)


def test_codes_are_scored_for_few_queries_at_a_time(spark):
    import numpy as np
    import pandas as pd

    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(r.normal(size=(300, 8)))], "vec_id long, embedding array<double>")
    quantizer = vectors.Quantizer(df, parts=4, codes=8)
    sizes, tables = [], quantizer.tables
    quantizer.tables = lambda q: sizes.append(len(q)) or tables(q)
    b = pd.DataFrame([(x.vec_id, x.code) for x in quantizer.encode(df).collect()], columns=["vec_id", "code"])
    found = list(vectors._by_codes(quantizer)(b, np.arange(200), r.normal(size=(200, 8)), 5))
    assert max(sizes) <= 64 and sorted(set(np.concatenate([x[0] for x in found]).tolist())) == list(range(200))
