"""Temperature mixing of sources, realised as budgeted block permutations.

A source's share of tokens is raised to an exponent between 0 (even weights) and 1 (as they are) and normalised. The
exponent is bisected: the greatest one whose weights have at least a target entropy (a share of the greatest possible),
or the smallest one for which no source is repeated more than a limit. Entropy and repetition are monotone in it.

The budget of tokens is given, or is the least that uses every document of every source once: then the source with
most tokens for its weight passes once, and others pass up to the limit. A source's documents are dealt into blocks by
a hash. Each pass takes the blocks in an order of its own, and the documents of a block in an order of its own, until
the source's budget is spent: whole passes, then whole blocks, then documents of the last block. Each use of a document
has its place in its source's pass, so that (source, epoch, position) is the permutation. Sums over blocks, and over
stretches of some STRETCH blocks, give each block its first place and the tokens before it, so that no sort holds more
than a block or a stretch.

A null source is a source of its own. Null and empty texts have no tokens; they come once in each whole pass.
A source without tokens passes once. Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import WORD, stored, text_or_empty

#: Most passes over a source, and documents in a block.
REPEATS, BLOCK = 4.0, 2_000
#: Blocks that are sorted together.
STRETCH = 1_000
#: Sources whose shares are summed on the driver; with more, each step of the bisection is an aggregation.
LOCAL_SOURCES = 10_000
STEPS = 40


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _powers(totals: DataFrame):
    """Function of an exponent: (sum of powers, entropy of the weights, least and greatest tokens^(exponent - 1))."""
    from math import exp, log

    some = [r[0] for r in totals.select("tokens").limit(LOCAL_SOURCES + 1).collect()]
    if len(some) <= LOCAL_SOURCES:
        logs = sorted(log(t) for t in some)

        def of(a: float):
            p = [exp(a * x) for x in logs]
            z = sum(p)
            return z, sum(-q / z * log(q / z) for q in p if q), exp((a - 1) * logs[-1]), exp((a - 1) * logs[0])
    else:

        def of(a: float):
            x = F.log("tokens")
            p = F.exp(a * x)
            r = totals.agg(F.sum(p).alias("z"), F.sum(p * a * x).alias("s"), F.min(F.exp((a - 1) * x)).alias("lo"), F.max(F.exp((a - 1) * x)).alias("hi")).first()
            return r.z, log(r.z) - r.s / r.z, r.lo, r.hi

    return of, len(some)


def exponent(totals: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: float | None = None) -> float:
    """The exponent for a table (tokens > 0) of sources. entropy: as a share of that of even weights."""
    from math import log

    of, n = _powers(totals)
    if n < 2:
        return 1.0
    n = n if n <= LOCAL_SOURCES else totals.count()

    def even_enough(a: float) -> bool:
        return entropy is None or of(a)[1] >= entropy * log(n)

    def too_often(a: float) -> bool:
        z, _, least, most = of(a)
        # passes over a source: budget * tokens^a / z / tokens
        passes = most / least if budget is None else budget * most / z
        return repeats is not None and passes > repeats

    if entropy is not None:
        lo, hi = 0.0, 1.0  # lo is even enough
        if even_enough(hi):
            return hi
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if even_enough(mid) else (lo, mid)
        return lo
    lo, hi = 0.0, 1.0  # hi repeats no source too often
    if not too_often(lo):
        return lo
    for _ in range(STEPS):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if too_often(mid) else (lo, mid)
    return hi


def plan(totals: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """totals (source, docs, tokens) with weight and passes."""
    real = totals.where("tokens > 0")
    a = exponent(real, repeats, entropy, budget)
    power = F.pow("tokens", F.lit(a))
    sums = real.agg(F.sum(power).alias("z"), F.max(F.col("tokens") / power).alias("most")).first()
    whole = (sums.most or 0.0) * (sums.z or 0.0) if budget is None else budget
    weight = F.when(F.col("tokens") > 0, power / (sums.z or 1.0)).otherwise(0.0)
    passes = F.when(F.col("tokens") > 0, F.round(weight * whole / F.col("tokens"), 9)).otherwise(1.0)
    return totals.withColumns({"weight": weight, "passes": passes})


def _placed(blocks: DataFrame, h) -> DataFrame:
    """(_source, _block, epoch, size, whole, rows_before, room) for each block and pass. blocks: (source, block, rows,
    size, passes, tokens); room: tokens that are left of a last pass when it comes to the block."""
    last = F.floor("passes").cast("int")
    each = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("passes").cast("int"), F.lit(1)) - 1)))
    each = each.withColumn("at", h("source", "block", "epoch"))
    # stretches in the order of the hash, so that their sums come before those within them
    each = each.withColumn("stretch", F.floor((F.col("at") / float(1 << 64) + 0.5) * F.ceil(F.col("docs") / (BLOCK * STRETCH))))
    sums = each.groupBy("source", "epoch", "stretch").agg(F.sum("rows").alias("r"), F.sum("size").alias("t"))
    earlier = Window.partitionBy("source", "epoch").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = sums.select(F.col("source").alias("_source"), F.col("epoch").alias("_epoch"), F.col("stretch").alias("_stretch"), zero(F.sum("r").over(earlier)).alias("r"), zero(F.sum("t").over(earlier)).alias("t"))
    within = Window.partitionBy("source", "epoch", "stretch").orderBy("at", "block").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumns({"rows_in": zero(F.sum("rows").over(within)), "size_in": zero(F.sum("size").over(within))})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("epoch") == F.col("_epoch")) & (F.col("stretch") == F.col("_stretch"))
    room = F.floor((F.col("passes") - last) * F.col("tokens")) - F.col("t") - F.col("size_in")
    out = each.join(sums, same).select(F.col("source").alias("_source"), F.col("block").alias("_block"), "epoch", "size", (F.col("epoch") < last).alias("whole"), (F.col("r") + F.col("rows_in")).alias("rows_before"), room.alias("room"))
    return out.where("whole or room > 0")


def mix(docs: DataFrame, source: str = "source", repeats: float | None = REPEATS, entropy: float | None = None, budget: float | None = None, seed: int = 7, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """(row, source, doc_id, n_tokens, weight, passes, epoch, block, position) for each time that a row of docs is used.

    position: gapless from 0 in each pass (source, epoch). row: a column of docs that numbers its rows; rows are
    numbered as they are read without it."""
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(F.col(source).cast("string").alias("source"), F.col("doc_id"), tokens(text_or_empty()).alias("n_tokens"), number.alias("row"))
    rows = stored(rows, "lengths")
    totals = stored(rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")), "sources")
    planned = stored(plan(totals, repeats, entropy, budget), "plan")
    planned = planned.select(F.col("source").alias("_source"), "docs", "tokens", "weight", "passes")
    same = F.col("source").eqNullSafe(F.col("_source"))
    h = lambda *x: F.xxhash64(*x, F.lit(seed))
    blocks = F.greatest(F.ceil(F.col("docs") / block), F.lit(1))
    dealt = rows.join(planned, same).drop("_source").withColumn("block", F.pmod(h("row", "source"), blocks))
    dealt = stored(dealt, "dealt")
    sizes = dealt.groupBy("source", "block", "docs", "passes", "tokens").agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("size"))
    placed = stored(_placed(stored(sizes, "sizes"), h), "blocks")
    used = dealt.join(placed, same & (F.col("block") == F.col("_block")))
    within = Window.partitionBy("source", "epoch", "block").orderBy(h("row", "epoch"), "row").rowsBetween(Window.unboundedPreceding, 0)
    cut = ~F.col("whole") & (F.col("size") > F.col("room"))
    # of a block that is cut, documents without tokens stay away
    counts = F.when(cut & (F.col("n_tokens") == 0), 0).otherwise(1)
    used = used.withColumns({"upto": F.sum("n_tokens").over(within), "n": F.sum(counts).over(within)})
    used = used.where(~cut | ((F.col("upto") <= F.col("room")) & (F.col("n_tokens") > 0)))
    return used.select("row", "source", "doc_id", "n_tokens", "weight", "passes", "epoch", "block", (F.col("rows_before") + F.col("n") - 1).cast("long").alias("position"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs as often as their source's passes say. Rows are numbered in a stored copy, so that a lost
    executor cannot number them anew between the two readings."""
    row, times = (next(x for x in (name + "_" * i for i in range(len(docs.columns) + 1)) if x not in docs.columns) for name in ("_row", "_times"))
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    often = mix(numbered, row=row, **options).groupBy(F.col("row").alias(row)).agg(F.count("*").cast("int").alias(times))
    return numbered.join(often, row).withColumn(row, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*(F.col(f"`{c}`") for c in docs.columns))
