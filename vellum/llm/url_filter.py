"""URL verdicts: rules first, then gradient-boosted trees on lexical features; DataFrame functions only.

Rules are host/path prefixes: a rule fits its host and all subdomains if the url's path starts with its path, and the
longest one that fits wins. The urls that rules decide, or those of a given table (url, allowed), are the labels the
trees learn from. Counts of suffixes are made over all labelled urls; the trees are fitted on the driver on at most
`fit_rows` of them (those with the smallest hashes, a documented bound of the fit, not of the data judged). The fitted
trees become one column expression, which runs inside the generated code of the scan.

A url that is null or has no "://" has an empty host and path, fits no rule and is judged by its features, all zero
for a null url. Very long urls are judged whole. Repeated rows get equal verdicts. With no labelled urls every url that
no rule fits is allowed. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import stored

#: (verdict, rule), the rule as host/path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
FIT_ROWS, TREES, DEPTH, RATE, BINS, LEAST_LEAF = 4_000, 24, 3, 0.2, 32, 20
#: Weight of the mean over all labels in a suffix's share of allowed urls.
SMOOTHING = 10.0
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-._/"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "params", "query_length", "hyphens", "longest_run", "suffix_share", "suffix_labels")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def suffix(host: Column) -> Column:
    """What stands after the last dot of a host."""
    return F.substring_index(host, ".", -1)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features as doubles; those of a null url are zero."""
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    low = F.lower(u)
    counts = F.transform(F.array(*map(F.lit, SYMBOLS)), lambda c: (F.length(low) - F.length(F.replace(low, c, F.lit("")))).cast("double"))
    query = F.regexp_extract(u, r"\?[^#]*", 0)
    out = {
        "length": F.length(u),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/+[^/]")),
        "labels": F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))),
        "digits": F.length(F.regexp_replace(u, "[^0-9]", "")) / n,
        "entropy": F.aggregate(counts, F.lit(0.0), lambda a, c: a - F.when(c > 0, c / n * F.log2(c / n)).otherwise(0.0)),
        "params": F.regexp_count(query, F.lit("[?&][^&]")),
        "query_length": F.length(query),
        "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
        "longest_run": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(path, F.lit("([A-Za-z0-9]+)"), 1), F.length)), F.lit(0)),
    }
    return {k: v.cast("double") for k, v in out.items()}


class Trees:
    """Boosted trees for a yes or no, grown on binned features with the logistic loss."""

    def __init__(self, base: float, trees: list):
        self.base, self.trees = base, trees

    @classmethod
    def fit(cls, rows: list[list[float]], labels: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, least: int = LEAST_LEAF) -> Trees:
        import numpy as np

        x, y = np.asarray(rows, float), np.asarray(labels, float)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        base = float(np.log(share / (1 - share)))
        if share in (1e-3, 1 - 1e-3):
            return cls(base, [])
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        raw, grown = np.full(len(y), base), []

        def grow(at, g, h, left: int):
            best = (1e-6, None, None)
            if left and len(at) >= 2 * least:
                total_g, total_h = g[at].sum(), h[at].sum()
                for j, e in enumerate(edges):
                    c = codes[at, j]
                    n, sg, sh = (np.cumsum(np.bincount(c, w, len(e) + 1))[:-1] for w in (None, g[at], h[at]))
                    ok = (n >= least) & (len(at) - n >= least)
                    gain = np.where(ok, sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - total_g**2 / (total_h + 1), 0)
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), j, int(gain.argmax()))
            if best[1] is None:
                return float(round(rate * g[at].sum() / (h[at].sum() + 1), 9))
            low = codes[at, best[1]] <= best[2]
            return (best[1], float(edges[best[1]][best[2]]), grow(at[low], g, h, left - 1), grow(at[~low], g, h, left - 1))

        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            tree = grow(np.arange(len(y)), y - p, p * (1 - p), depth)
            raw += [cls._of(tree, r) for r in x]
            grown.append(tree)
        return cls(base, grown)

    @classmethod
    def _of(cls, tree, row) -> float:
        while not isinstance(tree, float):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    def raw(self, row) -> float:
        return self.base + sum(self._of(t, row) for t in self.trees)

    def column(self, names: Sequence[str]) -> Column:
        def of(tree) -> Column:
            return F.lit(tree) if isinstance(tree, float) else F.when(F.col(names[tree[0]]) <= tree[1], of(tree[2])).otherwise(of(tree[3]))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + of(t)
        return out


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labels: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of pages (page_id, url). labels: (url, allowed)."""

    def read(df: DataFrame, *keep) -> DataFrame:
        host, path = parts(F.col("url"))
        df = df.select(*keep, F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
        return df

    pages = read(pages, "page_id")
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": rule, "_said": said})
    known = pages.where("_said is not null").select("url", "host", "path", (F.col("_said") == "allow").cast("int").alias("allowed")) if labels is None else read(labels, F.col("allowed").cast("int").alias("allowed")).where("allowed is not null")
    shares = stored(known.groupBy(suffix(F.col("host")).alias("_suffix")).agg(F.count("*").alias("_n"), F.sum("allowed").alias("_yes")), "suffixes")
    total = shares.agg(F.sum("_n").alias("n"), F.sum("_yes").alias("yes")).first()
    prior = total.yes / total.n if total.n else 1.0

    def featured(df: DataFrame, label: str | None = None) -> DataFrame:
        """df with its features. label: a url's own label, which its suffix's share must not tell the fit."""
        df = df.withColumn("_suffix", suffix(F.col("host"))).join(shares, "_suffix", "left")
        yes, n = (F.col("_yes"), F.col("_n")) if label is None else (F.col("_yes") - F.col(label), F.col("_n") - 1)
        share = (yes + SMOOTHING * prior) / (n + SMOOTHING)
        own = features(F.col("url"), F.col("host"), F.col("path")) | {"suffix_share": F.coalesce(share, F.lit(prior)), "suffix_labels": F.coalesce(F.log1p("_n"), F.lit(0.0))}
        return df.withColumns({f"_{k}": own[k] for k in FEATURES})

    names = [f"_{k}" for k in FEATURES]
    sample = known.groupBy("url", "host", "path").agg(F.max("allowed").alias("allowed")).orderBy(F.xxhash64("url"), "url").limit(fit_rows)
    rows = [(list(r[:-1]), r[-1]) for r in featured(sample, "allowed").select(*names, "allowed").collect()]
    trees = Trees.fit([x for x, _ in rows], [y for _, y in rows]) if rows else Trees(0.0, [])
    raw = featured(pages).withColumn("_raw", trees.column(names))
    score = 1 / (1 + F.exp(-F.col("_raw")))
    return raw.select("page_id", "host", "path", "rule", F.coalesce("_said", F.when(F.col("_raw") >= 0, "allow").otherwise("block")).alias("verdict"), score.alias("score"))
