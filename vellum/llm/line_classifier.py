"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. A line's features are shares of its character classes, its words' lengths and repeats, and
the same of the line before and after it; neighbouring labels have weights too. Lines learn the label of their
document. A document's quality is the mean of its lines' marginal probabilities of being good, by forward and backward
sums, weighted by line length.

The fit is on the driver, on the labelled documents with the smallest hashes of doc_id, at most `fit_docs` of them and
as many as have `fit_lines` lines together; both bound the fit only. They are fitted with all their lines, long ones in
pieces of PIECE lines. All documents and lines are scored, in batches.

A null or empty text is one empty line. With no labels, or labels of one kind, every line follows the share of good
labels (a half without any). Repeated rows get equal scores; several labels of a doc_id count as the lowest. Null
doc_ids are scored, and count as held out where their checksum is asked for. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import ship, text_or_empty

FIT_DOCS, FIT_LINES, PIECE, STEPS, RATE, RIDGE = 3_000, 100_000, 64, 200, 0.1, 1e-3
CLASSES = tuple(bytes(x, "ascii") for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>@^~=+_{}[]\\/", "!?", ".,;:", " \t\r"))
OWN = 13


def line_features(line: bytes, seen: bool) -> list[float]:
    n = len(line)
    words = line.split()
    m = len(words)
    share = [(n - len(line.translate(None, c))) / (n or 1) for c in CLASSES]
    return [
        1.0, min(n, 4000) ** 0.5 / 20, *share, min(40.0, n / (m or 1)) / 10, len(set(words)) / (m or 1),
        sum(map(bytes.__eq__, words, words[1:])) / (m or 1), float(line.rstrip()[-1:] in (b".", b"!", b"?")), float(seen),
    ]


def document_features(text: bytes):
    """(matrix of the lines' own, earlier and later features, lengths of the lines)."""
    import numpy as np

    lines, before = text.split(b"\n"), set()
    own = np.empty((len(lines), OWN))
    for i, x in enumerate(lines):
        own[i] = line_features(x, x in before)
        before.add(x)
    edge = np.zeros((1, OWN))
    return np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])]), np.fromiter(map(len, lines), float, len(lines)) + 1.0


class Chain:
    """Weights of the good label's features (the bad one's are zero) and of each pair of neighbouring labels."""

    def __init__(self, weights, pairs):
        self.weights, self.pairs = weights, pairs

    @classmethod
    def fit(cls, docs: list, labels: list[int], steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> Chain:
        """docs: feature matrices; all lines of a document have its label. Likelihood by Adam, all documents at once."""
        import numpy as np

        width = docs[0].shape[1] if docs else 3 * OWN
        y = np.asarray(labels)
        if not len(y) or y.min() == y.max():
            share = (y.sum() + 1) / (len(y) + 2)
            w = np.zeros(width)
            w[0] = np.log(share / (1 - share))
            return cls(w, np.zeros((2, 2)))
        lengths = np.array([len(d) for d in docs])
        longest = lengths.max()
        x = np.zeros((len(docs), longest, width))
        for i, d in enumerate(docs):
            x[i, : len(d)] = d
        inside = np.arange(longest)[None, :] < lengths[:, None]
        # documents of both labels weigh the same in all
        weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean()) / len(y)
        theta, m1, m2 = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
        for step in range(1, steps + 1):
            w, t = theta[:width], theta[width:].reshape(2, 2)
            unary = np.stack([np.zeros(x.shape[:2]), x @ w], axis=2)
            marginal, paired = cls._sums(unary, t, inside)
            gap = (y[:, None] - marginal) * inside * weight[:, None]
            grad_w = np.einsum("dt,dtf->f", gap, x)
            seen = np.zeros((2, 2))
            for v in (0, 1):
                seen[v, v] = ((lengths - 1) * weight)[y == v].sum()
            grad = np.concatenate([grad_w, (seen - (paired * weight[:, None, None]).sum(axis=0)).ravel()]) - ridge * theta
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
            theta = theta + rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        return cls(theta[:width], theta[width:].reshape(2, 2))

    @staticmethod
    def _sums(unary, t, inside):
        """Marginals of label 1, and expected counts of neighbouring labels, for each document."""
        import numpy as np

        docs, longest, _ = unary.shape
        e = np.exp(unary - unary.max(axis=2, keepdims=True))
        move = np.exp(t - t.max())
        forward, backward = np.zeros_like(e), np.ones_like(e)
        a = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        forward[:, 0] = a
        for i in range(1, longest):
            b = (a @ move) * e[:, i]
            a = np.where(inside[:, i, None], b / b.sum(axis=1, keepdims=True), a)
            forward[:, i] = a
        later = np.ones((docs, 2))
        paired = np.zeros((docs, 2, 2))
        for i in range(longest - 2, -1, -1):
            reach = e[:, i + 1] * later
            both = forward[:, i, :, None] * move * reach[:, None, :]
            paired += np.where(inside[:, i + 1, None, None], both / both.sum(axis=(1, 2), keepdims=True), 0)
            b = reach @ move.T
            later = np.where(inside[:, i + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
            backward[:, i] = later
        both = forward * backward
        return (both[:, :, 1] / both.sum(axis=2)), paired

    def marginals(self, odds: list[float]) -> list[float]:
        """Probability of good for each line of one document; odds: its features' weighted sums."""
        from math import exp

        (p00, p01), (p10, p11) = ([exp(v - self.pairs.max()) for v in row] for row in self.pairs)
        e = [1 / (1 + exp(-min(50.0, max(-50.0, v)))) for v in odds]
        bad, good, ahead = 1 - e[0], e[0], []
        ahead.append((bad, good))
        for g in e[1:]:
            b, a = (bad * p00 + good * p10) * (1 - g), (bad * p01 + good * p11) * g
            bad, good = b / (a + b), a / (a + b)
            ahead.append((bad, good))
        lb = lg = 1.0
        out = [0.0] * len(e)
        for i in range(len(e) - 1, -1, -1):
            b, a = ahead[i][0] * lb, ahead[i][1] * lg
            out[i] = a / (a + b)
            rb, rg = (1 - e[i]) * lb, e[i] * lg
            lb, lg = p00 * rb + p01 * rg, p10 * rb + p11 * rg
            lb, lg = lb / (lb + lg), lg / (lb + lg)
        return out


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3; 1 is held out. A null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(1))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_lines: int = FIT_LINES) -> Chain:
    """A chain fitted to the labelled rows of docs that are not held out. labels: (doc_id, quality)."""
    import numpy as np

    wanted = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("_label")).where(fold(F.col("doc_id")) != 1)
    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    n_lines = F.length("text") - F.length(F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")).cast("binary")) + 1
    ids = rows.select("doc_id", n_lines.alias("_n")).join(wanted, "doc_id").groupBy("doc_id").agg(F.first("_label").alias("_label"), F.sum("_n").alias("_n"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    first = ids.orderBy(*order).limit(fit_docs)  # a window over so many rows at most
    upto = F.sum("_n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    ids = first.withColumn("_upto", upto).where(F.col("_upto") <= fit_lines).select("doc_id", "_label")
    texts = rows.join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [document_features(t)[0].astype("float32") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_label"), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "_label", "x"])

    held = sorted(texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, _label {dict(texts.dtypes)['_label']}, x binary").collect(), key=lambda r: (r.doc_id, bytes(r.x)))
    whole = [(np.frombuffer(r.x, "float32").reshape(-1, 3 * OWN).astype(float), int(r._label)) for r in held]
    parts = [(x[at : at + PIECE], y) for x, y in whole for at in range(0, len(x), PIECE)]
    return Chain.fit([x for x, _ in parts], [y for _, y in parts])


def score(docs: DataFrame, chain: Chain, name: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns `keep` of docs (all), and the quality of each text."""
    columns = [c for c in docs.columns if c != name] if keep is None else keep
    read = next(x for x in ("_bytes" + "_" * i for i in range(len(columns) + 1)) if x not in columns)
    kept = docs.select(*(F.col(f"`{c}`") for c in columns), text_or_empty().cast("binary").alias(read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            out = []
            for t in b.column(b.num_columns - 1).to_pylist():
                x, n = document_features(t)
                out.append(float(np.dot(chain.marginals((x @ chain.weights).tolist()), n) / n.sum()))
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.float64())], schema=pa.schema([*list(b.schema)[:-1], pa.field(name, pa.float64())]))

    schema = kept.drop(read).schema.add(name, "double")
    return kept.mapInArrow(run, schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    chain = train(docs, labels)
    out = score(docs, chain, keep=("doc_id",))
    return out.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs of good quality."""
    name = next(x for x in ("_quality" + "_" * i for i in range(len(docs.columns) + 1)) if x not in docs.columns)
    return score(docs, train(docs, labels), name).where(F.col(name) >= least).select(*(F.col(f"`{c}`") for c in docs.columns))


ship(sys.modules[__name__])
