"""Vector search over stored embeddings: exact, inverted lists, product quantisation."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most results of a search, and most queries that are broadcast at once; more are searched block by block.
MOST_K, MOST_QUERIES = 500, 1_000
#: Queries that are sent as one matrix to the tasks of an exact search, or of one of inverted lists.
BLOCK = 16_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0))


def int8(v: Column) -> Column:
    """128 times each component, cut to the range of a byte."""
    return F.transform(v, lambda x: F.greatest(F.lit(-128), F.least(F.lit(127), (x * 128).cast("int"))).cast("tinyint"))


def blocks(queries: DataFrame) -> list[DataFrame]:
    """All queries, in blocks of about half of MOST_QUERIES by the hash of their ids; one block if they are few."""
    n = -(-2 * queries.count() // MOST_QUERIES)
    return [queries] if n <= 2 else [queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i) for i in range(n)]


def search(data: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest by inner product of each query."""
    return _nearest(data.select("vec_id", "embedding"), queries, min(k, MOST_K))


def _odd(v: Column) -> Column:
    """Vectors that are null or hold a value that is no finite number."""
    return v.isNull() | F.coalesce(F.exists(v, lambda x: x.isNull() | ~(F.abs(x) < float("inf")) | F.isnan(x)), F.lit(False))


def _nearest(data: DataFrame, queries: DataFrame, k: int, centres=None, nprobe: int = 0) -> DataFrame:
    """The k nearest rows of each query; with centres, those of the nprobe lists (a column of data) nearest to it.

    Products of a batch of rows with all queries of a block are one product of matrices. What may be among the k best by
    rounded scores is added up again in the order of `dot`, so scores are the same to the last bit. Vectors that are null
    or not finite are few, and scored as columns."""
    kept = ["vec_id", "embedding"] + (["list"] if centres is not None else [])
    queries = queries.select("vec_id", "embedding").withColumn("_odd", _odd(F.col("embedding")))
    n = -(-queries.count() // BLOCK) or 1
    parts, plain = [], data.where(~_odd(F.col("embedding"))).select(*kept)
    for i in range(n):
        block = queries if n == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i)
        rows = block.collect()
        for wide in sorted({len(r.embedding) for r in rows if not r._odd}):
            some = [r for r in rows if not r._odd and len(r.embedding) == wide]
            parts.append(plain.where(F.size("embedding") == wide).mapInArrow(_products(plain.sparkSession, some, k, centres, nprobe), "query_id long, vec_id long, score double"))
            parts.append(_columns(plain.where(F.size("embedding") != wide), block.where(~F.col("_odd") & (F.size("embedding") == wide)), centres, nprobe))
        if any(r._odd for r in rows):
            parts.append(_columns(plain, block.where("_odd"), centres, nprobe))
        parts.append(_columns(data.where(_odd(F.col("embedding"))).select(*kept), block, centres, nprobe))
    found = reduce(DataFrame.unionAll, parts).withColumn("score", F.round("score", 6))
    return _best(found, k)


def _columns(data: DataFrame, queries: DataFrame, centres, nprobe: int) -> DataFrame:
    """(query_id, vec_id, score) of all pairs, or of those of the lists that are read."""
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_q"))
    test = F.col("vec_id") != F.col("query_id")
    if centres is not None:
        near = F.transform(F.array(*(F.array(*map(F.lit, c)) for c in centres)), lambda c, i: F.struct((-dot(c, F.col("_q")) + dot(c, c) / 2).alias("d"), i.alias("list")))
        q, test = q.withColumn("_lists", F.slice(F.array_sort(near), 1, nprobe)["list"]), test & F.array_contains("_lists", F.col("list"))
    return data.join(F.broadcast(q), test).select("query_id", "vec_id", dot(F.col("embedding"), F.col("_q")).alias("score"))


def _folded(a, b):
    """Inner products of rows, added up from the first component on."""
    out = 0.0
    for j in range(a.shape[-1]):
        out = out + a[..., j] * b[..., j]
    return out


def _products(spark, rows: list, k: int, centres, nprobe: int):
    import numpy as np

    ids, q, probes = np.array([r.vec_id for r in rows], np.int64), np.array([r.embedding for r in rows], float), None
    if centres is not None:
        c = np.array(centres, float)
        far = -_folded(c[None], q[:, None]) + _folded(c, c) / 2
        probes = np.zeros((len(q), len(c)), bool)
        np.put_along_axis(probes, np.argsort(far, axis=1, kind="stable")[:, :nprobe], True, axis=1)
    sent = spark.sparkContext.broadcast((ids, q, probes))

    def run(batches):
        import pyarrow as pa

        ids, q, probes = sent.value
        floor = np.full(len(ids), -np.inf)
        for b in batches:
            if not b.num_rows:
                continue
            vec, x = b["vec_id"].to_numpy(), b["embedding"].flatten().to_numpy().astype(float).reshape(b.num_rows, -1)
            for at in range(0, len(ids), 128):
                me, mine = ids[at : at + 128], q[at : at + 128]
                near = mine @ x.T
                # beyond what rounding to six places and the order of additions can change
                slack = 2e-6 + 1e-12 * float(np.abs(mine).sum(axis=1).max() * np.abs(x).max(initial=0.0))
                near[me[:, None] == vec[None, :]] = -np.inf
                if probes is not None:
                    near[~probes[at : at + 128][:, b["list"].to_numpy()]] = -np.inf
                if len(vec) > k:
                    kth = np.partition(near, len(vec) - k, axis=1)[:, len(vec) - k]
                    floor[at : at + 128] = np.maximum(floor[at : at + 128], kth - slack)
                i, j = np.nonzero((near >= floor[at : at + 128, None]) & np.isfinite(near))
                score = _folded(mine[i], x[j])
                by = np.lexsort((vec[j], -score, i))
                i, j, score = i[by], j[by], score[by]
                # of equal scores the k of the smallest ids
                new = np.r_[True, (i[1:] != i[:-1]) | (score[1:] != score[:-1])] if len(i) else np.zeros(0, bool)
                few = np.arange(len(i)) - np.maximum.accumulate(np.where(new, np.arange(len(i)), 0)) < k
                yield pa.RecordBatch.from_arrays([pa.array(me[i[few]]), pa.array(vec[j[few]]), pa.array(score[few])], names=["query_id", "vec_id", "score"])

    return run


def fused(found: DataFrame, k: int) -> DataFrame:
    """The k best ids over all queries, by their best score."""
    return found.groupBy("vec_id").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "vec_id").limit(min(k, MOST_K))


class InvertedLists:
    """Rows dealt to k-means centroids; a search reads the nprobe lists nearest to each query.

    Recall at 10 of the 13 probes, against brute force: 0.98 or more on sf0.001, sf0.01, sf0.1, check_s and check_h (4 probes: 0.57
    to 0.72). Those vectors have no clusters, so few lists can be left out."""

    def __init__(self, data: DataFrame, lists: int = 16, seed: int = 7, fit_rows: int = 50_000):
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        self.vectors = data.select("vec_id", "embedding", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        sample = self.vectors.orderBy(F.xxhash64("vec_id")).limit(fit_rows)
        self.model = KMeans(k=lists, seed=seed, maxIter=10).fit(sample)
        self.centres = [c.tolist() for c in self.model.clusterCenters()]
        self.lists = self.model.transform(self.vectors).select("vec_id", "embedding", F.col("prediction").alias("list"))

    def search(self, queries: DataFrame, k: int = 10, nprobe: int = 13) -> DataFrame:
        return _nearest(self.lists, queries, min(k, MOST_K), self.centres, nprobe)


def _sample(data: DataFrame, rows: int):
    """Matrix of at most so many vectors, those with the smallest hashes of their ids."""
    import numpy as np

    return np.array([r.embedding for r in data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("embedding").collect()], float)


def _means(x, k: int, seed: int, rounds: int = 10):
    """k-means of a bounded sample on the driver."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        centres = np.array([x[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


class Quantizer:
    """Product quantisation: a vector is cut into parts of all its components, as even as they go, and each part is the
    number of its nearest centre, a byte. Centres are fitted on at most fit_rows vectors; all vectors are coded."""

    def __init__(self, data: DataFrame, parts: int = 16, codes: int = 64, seed: int = 7, fit_rows: int = 10_000):
        x = _sample(data, fit_rows)
        width = x.shape[1] if len(x) else 0
        ends = [width * i // parts for i in range(parts + 1)]
        self.cuts = [(a, b) for a, b in zip(ends, ends[1:]) if b > a]
        self.centres = [_means(x[:, a:b], min(codes, 256), seed + i) for i, (a, b) in enumerate(self.cuts)]

    def encode(self, data: DataFrame) -> DataFrame:
        """data (vec_id, embedding, ...) with `code`, a byte for each part."""
        cuts, centres = self.cuts, self.centres

        @F.pandas_udf("binary")
        def code(v: pd.Series) -> pd.Series:
            import numpy as np

            x = np.array(v.tolist(), float)
            near = [((c**2).sum(axis=1) - 2 * x[:, a:b] @ c.T).argmin(axis=1) for (a, b), c in zip(cuts, centres)]
            return pd.Series([r.tobytes() for r in np.stack(near, axis=1).astype(np.uint8)])

        return data.withColumn("code", code("embedding"))

    def tables(self, queries):
        """Inner products of the parts of each query (a matrix) with all centres."""
        return [queries[:, a:b] @ c.T for (a, b), c in zip(self.cuts, self.centres)]


def _best(found: DataFrame, k: int, score: str = "score") -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc(score), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _scored(batches_of, data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, near): the k best of each batch of data for each query, by batches_of(ids, matrix of queries)
    and a table of rows; queries are one block."""
    rows = queries.select("vec_id", "embedding").collect()  # at most MOST_QUERIES or so
    spark = data.sparkSession
    import numpy as np

    sent = spark.sparkContext.broadcast((np.array([r.vec_id for r in rows], np.int64), np.array([r.embedding for r in rows], float)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = sent.value
        if not len(ids):
            return
        for b in batches:
            for qi, vec, near in batches_of(b, ids, q, k):
                yield pd.DataFrame({"query_id": ids[qi], "vec_id": vec, "near": near})

    return data.mapInPandas(run, "query_id long, vec_id long, near double")


def _ranked(found: DataFrame, data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Found pairs (query_id, vec_id) with their exact scores, the k best of each query."""
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_q"))
    exact = found.where("query_id != vec_id").join(data.select("vec_id", "embedding"), "vec_id").join(q, "query_id")
    return _best(exact.select("query_id", "vec_id", F.round(dot(F.col("embedding"), F.col("_q")), 6).alias("score")), k)


def _by_codes(quantizer: Quantizer):
    def of(b: pd.DataFrame, ids, q, k: int):
        import numpy as np

        code = np.frombuffer(b"".join(b["code"]), np.uint8).reshape(len(b), -1)
        vec = b["vec_id"].to_numpy()
        for at in range(0, len(ids), 64):  # queries at a time, as sums are a number for each query and row
            near = np.zeros((len(ids[at : at + 64]), len(vec)))
            for p, t in enumerate(quantizer.tables(q[at : at + 64])):
                near += t[:, code[:, p]]
            if "probes" in b.attrs:
                near[~np.array(b.attrs["probes"])[at : at + 64][:, b["list"].to_numpy()]] = -np.inf
            top = np.argpartition(-near, min(k, len(vec) - 1), axis=1)[:, : k + 1]
            rows = np.repeat(np.arange(len(near)), top.shape[1])
            best = near[rows, top.ravel()]
            good = np.isfinite(best)
            yield at + rows[good], vec[top.ravel()[good]], best[good]

    return of


class ProductIndex:
    """Codes of all vectors. A search adds up table entries for each code, keeps refine * k candidates of each query,
    and ranks those by their exact scores."""

    def __init__(self, data: DataFrame, **options):
        self.data = data.select("vec_id", "embedding")
        self.quantizer = Quantizer(self.data, **options)
        self.codes = self.quantizer.encode(self.data).select("vec_id", "code")

    def search(self, queries: DataFrame, k: int = 10, refine: int = 20) -> DataFrame:
        k = min(k, MOST_K)

        def one(q: DataFrame) -> DataFrame:
            found = _best(_scored(_by_codes(self.quantizer), self.codes, q, refine * k), refine * k, "near")
            return _ranked(found, self.data, q, k)

        return reduce(DataFrame.unionAll, (one(q) for q in blocks(queries)))


class InvertedProductIndex(ProductIndex):
    """The same within lists: vectors are dealt to k-means centres, and a search reads the codes of the nprobe lists
    nearest to each query."""

    def __init__(self, data: DataFrame, lists: int = 16, seed: int = 7, fit_rows: int = 10_000, **options):
        super().__init__(data, seed=seed, fit_rows=fit_rows, **options)
        centres = self.means = _means(_sample(self.data, fit_rows), lists, seed)

        @F.pandas_udf("int")
        def nearest(v: pd.Series) -> pd.Series:
            import numpy as np

            x = np.array(v.tolist(), float)
            return pd.Series(((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1))

        self.codes = self.quantizer.encode(self.data).select("vec_id", "code", nearest("embedding").alias("list"))

    def search(self, queries: DataFrame, k: int = 10, refine: int = 20, nprobe: int = 13) -> DataFrame:
        k, means, plain = min(k, MOST_K), self.means, _by_codes(self.quantizer)

        def probed(b: pd.DataFrame, ids, q, k: int):
            import numpy as np

            near = np.argsort((means**2).sum(axis=1) - 2 * q @ means.T, axis=1)[:, :nprobe]
            b.attrs["probes"] = np.zeros((len(ids), len(means)), bool)
            np.put_along_axis(b.attrs["probes"], near, True, axis=1)
            yield from plain(b, ids, q, k)

        def one(q: DataFrame) -> DataFrame:
            return _ranked(_best(_scored(probed, self.codes, q, refine * k), refine * k, "near"), self.data, q, k)

        return reduce(DataFrame.unionAll, (one(q) for q in blocks(queries)))


class Graph:
    """Layers of neighbour graphs over a block of vectors. Layer i holds about one in SPARSE ** i of the rows, drawn
    by a seed; each row has edges to its `degree` nearest rows of the layer, in both directions."""

    SPARSE = 16

    def __init__(self, x, degree: int = 16, seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.x, rows = x, np.arange(len(x))
        self.layers: list[dict[int, list[int]]] = []
        while True:
            edges: dict[int, set[int]] = {int(r): set() for r in rows}
            part = x[rows]
            for at in range(0, len(rows), 1_024):
                d = (part**2).sum(axis=1)[None, :] - 2 * part[at : at + 1_024] @ part.T
                near = np.argpartition(d, min(degree, len(rows) - 1), axis=1)[:, : degree + 1]
                for i, mine in enumerate(near):
                    a = int(rows[at + i])
                    for b in rows[mine].tolist():
                        if a != b:
                            edges[a].add(b)
                            edges[b].add(a)
            self.layers.append({a: sorted(b) for a, b in edges.items()})
            if len(rows) <= 2 * degree:
                break
            rows = np.sort(rng.choice(rows, max(1, len(rows) // self.SPARSE), replace=False))
        self.entry = rows.tolist()

    def search(self, q, width: int) -> list[tuple[float, int]]:
        """The `width` best rows met, (inner product, row), by a beam that starts from the top layer's best row."""
        import heapq

        x = self.x
        start = max(self.entry, key=lambda r: float(x[r] @ q))
        for layer in self.layers[:0:-1]:
            better = True
            while better:
                near = max(layer[start], key=lambda r: float(x[r] @ q), default=start)
                better = float(x[near] @ q) > float(x[start] @ q)
                start = near if better else start
        first = float(x[start] @ q)
        seen, open_, best = {start}, [(-first, start)], [(first, start)]
        while open_:
            s, row = heapq.heappop(open_)
            if len(best) >= width and -s < best[0][0]:
                break
            new = [r for r in self.layers[0][row] if r not in seen]
            seen.update(new)
            for r, score in zip(new, (x[new] @ q).tolist() if new else ()):
                if len(best) < width or score > best[0][0]:
                    heapq.heappush(open_, (-score, r))
                    heapq.heappush(best, (score, r))
                    if len(best) > width:
                        heapq.heappop(best)
        return sorted(best, reverse=True)


class GraphIndex:
    """Graphs over blocks of rows, each built and searched where its rows lie; the best of all blocks are ranked by
    their exact scores. A block is the rows of one task, in batches of at most `block`, so memory is bounded."""

    def __init__(self, data: DataFrame, degree: int = 16, block: int = 5_000, seed: int = 7):
        self.data, self.options, self.block = data.select("vec_id", "embedding"), {"degree": degree, "seed": seed}, block

    def search(self, queries: DataFrame, k: int = 10, width: int = 200) -> DataFrame:
        k, options, block = min(k, MOST_K), self.options, self.block

        def of(b: pd.DataFrame, ids, q, k: int):
            import numpy as np

            for at in range(0, len(b), block):
                part = b.iloc[at : at + block]
                g, vec = Graph(np.array(part["embedding"].tolist(), float), **options), part["vec_id"].to_numpy()
                for i in range(len(ids)):
                    found = g.search(q[i], max(width, k + 1))[: k + 1]
                    yield np.full(len(found), i), vec[[r for _, r in found]], [s for s, _ in found]

        return reduce(DataFrame.unionAll, (_ranked(_best(_scored(of, self.data, q, k), k + 1, "near"), self.data, q, k) for q in blocks(queries)))


def pages(data: DataFrame, key: str, size: int) -> Iterator[DataFrame]:
    """data in pages of `size` rows by its key, each found from the last key of the page before, not by an offset."""
    after = None
    while True:
        page = (data if after is None else data.where(F.col(key) > after)).orderBy(key).limit(size)
        last = page.agg(F.max(key)).first()[0]
        if last is None:
            return
        yield page
        after = last


def chunks(data: DataFrame, size: int = 25_000) -> DataFrame:
    """data with `chunk`, the number of the part of at most `size` rows in which a reindex adds it. Parts are numbered
    from sums over a hash's values, so that no sort holds all rows."""
    parts = 1 + data.count() // (size // 2 or 1)
    return data.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))


def product_codes(data: DataFrame, parts: int = 8, codes: int = 16, seed: int = 7) -> DataFrame:
    """(vec_id, codes): for each part of a vector the number of its nearest centre; all components belong to a part."""
    out = Quantizer(data, parts, codes, seed).encode(data.select("vec_id", "embedding"))
    byte = lambda i: F.conv(F.hex(F.substring("code", i + 1, 1)), 16, 10).cast("int")
    return out.select("vec_id", F.array(*(byte(i) for i in range(parts))).alias("codes"))


def remove(data: DataFrame, ids: DataFrame) -> DataFrame:
    return data.join(ids.select("vec_id"), "vec_id", "left_anti")


def upsert(data: DataFrame, new: DataFrame) -> DataFrame:
    return remove(data, new).unionByName(new)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
