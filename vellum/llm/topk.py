"""Exact top-k by inner product with a dual-tree search over cover trees.

Vectors are quantised to integers, floor(256 x). All data is searched where it lies: each task builds a cover tree
over a block of its rows, and searches it together with a tree over a block of queries. For a query node and a data
node with centres c, d and covering radii r, s, no pair scores more than <c, d> + r |d| + s |c| + r s; where that is
below the worst k-th score of the query node's queries, the pair of nodes is pruned. Leaves are scored in one matrix
product. Queries come in blocks of a fixed number, so that what is sent to the executors has a proven size; before the
search, a bounded sample of the data gives each query a first k-th score, which later blocks must reach.

Equal vectors count as one point with their smallest k + 1 ids, so a vector that a third of all rows share is scored
once a block. Scores are exact in 64 bits; those beyond count as the ends of that range. Vectors that are null or hold null or non-finite components take no part, neither as queries nor as
candidates; so do rows with a null id. Vectors of another length than the first query's are compared as if padded
with zeros. Ties go to the smaller id. Repeated rows of an id count once. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import ship, stored

#: Rows of a leaf over data and over queries, and children of a node at most.
LEAF, QUERY_LEAF, CHILDREN = 1_024, 256, 16
#: Rows in a data block, queries in a block, rows of the sample that gives first bounds.
BLOCK, QUERIES, SAMPLE = 50_000, 20_000, 4_096
#: The score of no one, below all others; its negative is a number too.
NONE = -(1 << 63) + 1
FOUND = "query_id long, vec_id long, score long"


class CoverTree:
    """Nodes over rows of points: centre, covering radius, and children or a range of rows.

    The children of a node are the farthest points in turn, beginning with its own centre (nesting), until their
    scale, the greatest distance of a row from all of them, is half the node's radius, or there are CHILDREN of them.
    So each row lies within the scale of its child's centre (covering), and centres of children are at least that far
    from each other (separation). In many dimensions few children do not halve a radius; the scale is then what they
    attain, and a node's radius is always measured, so pruning is exact.
    """

    def __init__(self, points, leaf: int = LEAF):
        import numpy as np

        self.points, self.order = points, np.arange(len(points))
        self.centre, self.radius, self.span, self.children = [], [], [], []
        middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        work = [(0, len(points), -1, points[middle])]
        while work:
            lo, hi, parent, c = work.pop()
            rows = self.order[lo:hi]
            p = points[rows]
            far = np.sqrt(((p - c) ** 2).sum(axis=1))
            node, radius = len(self.radius), float(far.max())
            self.centre.append(c)
            self.radius.append(radius * (1 + 1e-9))
            self.span.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo <= leaf or radius == 0:
                continue
            of, centres = np.zeros(hi - lo, int), [c]
            while far.max() > radius / 2 and len(centres) < CHILDREN:
                at = int(far.argmax())
                d = np.sqrt(((p - p[at]) ** 2).sum(axis=1))
                of[d < far] = len(centres)
                far = np.minimum(far, d)
                centres.append(p[at])
            by = np.argsort(of, kind="stable")
            self.order[lo:hi] = rows[by]
            ends = lo + np.searchsorted(of[by], np.arange(len(centres) + 1))
            work += [(int(a), int(b), node, x) for a, b, x in zip(ends, ends[1:], centres) if b > a]
        self.centre = np.asarray(self.centre)
        self.radius = np.asarray(self.radius)
        self.norm = np.sqrt((self.centre**2).sum(axis=1))


class Best:
    """The k highest (score, smaller id first) of each query so far."""

    def __init__(self, ids, k: int, floor):
        import numpy as np

        self.ids, self.k = ids, k
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = floor

    def worst(self, rows) -> float:
        import numpy as np

        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    def offer(self, rows, scores, ids) -> None:
        """scores[i, j]: of query rows[i] with ids[j]. Only what reaches a query's k-th score is looked at."""
        import numpy as np

        reach = scores >= np.maximum(self.scores[rows, -1], self.floor[rows])[:, None]
        reach &= ids[None, :] != self.ids[rows][:, None]
        for i in np.nonzero(reach.any(axis=1))[0]:
            r = rows[i]
            s = np.concatenate([self.scores[r], scores[i, reach[i]]])
            n = np.concatenate([self.found[r], ids[reach[i]]])
            by = np.lexsort((n, -s))[: self.k]
            self.scores[r], self.found[r] = s[by], n[by]


def products(q, p):
    """Integer inner products of the rows of q with those of p, exact; those beyond a long become its ends."""
    import numpy as np

    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(p.astype(float)).max(initial=0)) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(float) @ p.astype(float).T).astype(np.int64)
    if most < 1 << 62:
        return q @ p.T
    return np.clip(q.astype(object) @ p.astype(object).T, NONE + 1, (1 << 63) - 1).astype(np.int64)


def search(queries, query_ids, points, ids: list, k: int, floor, leaf: int = LEAF, query_leaf: int = QUERY_LEAF):
    """Dual-tree search; ids[i]: the ids of point i, in order. Gives (query id, id, score) arrays."""
    import numpy as np

    qt, dt = CoverTree(queries.astype(float), query_leaf), CoverTree(points.astype(float), leaf)
    best = Best(query_ids, k, floor)
    alone = np.array([x[0] for x in ids])
    more = np.array([len(x) > 1 for x in ids])
    work = [(0, 0)]
    while work:
        q, d = work.pop()
        rows = qt.order[slice(*qt.span[q])]
        most = float(qt.centre[q] @ dt.centre[d]) + qt.radius[q] * dt.norm[d] + dt.radius[d] * qt.norm[q] + qt.radius[q] * dt.radius[d]
        slack = 1e-9 * (qt.norm[q] + qt.radius[q]) * (dt.norm[d] + dt.radius[d]) + 1e-6
        if most + slack < best.worst(rows):
            continue
        qs, ds = qt.children[q], dt.children[d]
        if not qs and not ds:
            at = dt.order[slice(*dt.span[d])]
            scores = products(queries[rows], points[at])
            best.offer(rows, scores, alone[at])
            for j in np.nonzero(more[at])[0]:
                rest = np.array(ids[at[j]][1:])
                best.offer(rows, np.repeat(scores[:, j : j + 1], len(rest), axis=1), rest)
        elif ds and (not qs or dt.radius[d] >= qt.radius[q]):
            near = dt.centre[ds] @ qt.centre[q] + dt.radius[ds] * qt.norm[q]
            work += [(q, ds[i]) for i in np.argsort(near)]  # the most promising is taken first
        else:
            work += [(x, d) for x in qs]
    full = best.found < np.iinfo(np.int64).max
    return np.repeat(query_ids, k).reshape(-1, k)[full], best.found[full], best.scores[full]


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component as array<long> (at its ends where that is beyond a long); null where the vector takes no part."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * 256)))


def _matrix(lists: list, width: int):
    import numpy as np

    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, : min(width, len(v))] = v[:width]
    return out


def _points(pairs: list[tuple[int, list]], width: int, k: int):
    """Different vectors with their smallest k + 1 ids."""
    held: dict[bytes, list[int]] = {}
    m = _matrix([v for _, v in pairs], width)
    rows: dict[bytes, int] = {}
    for i, (n, _) in enumerate(pairs):
        key = m[i].tobytes()
        rows.setdefault(key, i)
        mine = held.setdefault(key, [])
        mine.append(n)
        if len(mine) > 4 * k + 64:
            held[key] = sorted(set(mine))[: k + 1]
    return m[list(rows.values())], [sorted(set(held[key]))[: k + 1] for key in rows]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERIES, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of queries against all rows of vectors, both (id, v: array<long>)."""
    import numpy as np

    spark = vectors.sparkSession
    schema = f"query_id long, rank int, vec_id long, score long"  # noqa: F541
    data = stored(vectors.where("id is not null and v is not null").select(F.col("id").cast("long").alias("id"), "v"), "vectors")
    asked = stored(queries.where("id is not null and v is not null").select(F.col("id").cast("long").alias("id"), "v").dropDuplicates(["id"]).repartitionByRange("id"), "queries")
    first = [(r.id, r.v) for r in data.orderBy(F.xxhash64("id")).limit(sample).collect()]
    parts = []

    def flush(rows: list) -> None:
        width = max(len(v) for _, v in [*rows, *first]) if first else len(rows[0][1])
        q, ids = _matrix([v for _, v in rows], width), np.array([n for n, _ in rows])
        floor = np.full(len(rows), NONE)
        if first:
            seen = _points(first, width, k)
            found = search(q, ids, *seen, k, floor)
            worst: dict[int, list[int]] = {}
            for n, s in zip(found[0].tolist(), found[2].tolist()):
                worst.setdefault(n, []).append(s)
            floor = np.array([min(worst[n]) if len(worst.get(n, ())) == k else NONE for n in ids.tolist()])
        sent = spark.sparkContext.broadcast((q, ids, floor))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, ids, floor = sent.value
            held: list[tuple[int, list]] = []

            def out() -> pa.RecordBatch:
                wide = max([q.shape[1], *(len(v) for _, v in held)])
                qq = np.pad(q, ((0, 0), (0, wide - q.shape[1])))
                found = search(qq, ids, *_points(held, wide, k), k, floor)
                return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["query_id", "vec_id", "score"])

            for b in batches:
                held += zip(b.column("id").to_pylist(), b.column("v").to_pylist())
                if len(held) >= block:
                    yield out()
                    held = []
            if held:
                yield out()

        parts.append(data.mapInArrow(run, FOUND))

    rows: list = []
    for r in asked.toLocalIterator():
        rows.append((r.id, r.v))
        if len(rows) == query_block:
            flush(rows)
            rows = []
    if rows:
        flush(rows)
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """top_k of the rows of embeddings (vec_id, embedding) whose vec_id is divisible by `every`, against all rows."""
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("id"), quantised(F.col("embedding")).alias("v"))
    return top_k(vectors, vectors.where(F.col("id") % every == 0), k)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INT AS rank, vec_id, score FROM r WHERE k <= 5
"""

ship(sys.modules[__name__])
