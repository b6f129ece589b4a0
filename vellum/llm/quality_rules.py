"""Quality rules on whole texts, and perplexity bands of a modified Kneser-Ney model.

The model is over ORDER characters. A character is a code of CODE_BITS bits (code points below half of the codes stand
for themselves, others are spread over the rest), an n-gram a number of ORDER codes. Spark counts the n-grams of every
text for each language, none is dropped, and derives continuation counts, discounts and interpolated probabilities of
all orders by joins of those tables; they grow with the corpus. A text is never scored by its own counts: texts fall
into two halves by a hash of their text, so that equal texts share one, and each half is scored by the counts of the
other.

The probabilities go to the scan as arrays sorted by a hash of the n-gram, with an index by the hash's leading bits,
where there are at most MOST_SENT of them. Beyond that they are never gathered: documents are dealt into units of some
UNIT_CHARS characters, the n-grams of each unit are joined with the table, and each unit meets its own part of the
model in one task. Both ways give the same results.

A document's perplexity is over all of its characters, by the model of its own language. For each language the centre
of the band is the median of log perplexity over all documents that pass the base rules, and its half-width WIDTH
times the median absolute deviation (scaled to a normal's), both over the whole corpus, from counts of values rounded
to 1 / GRID; short texts get a wider band, in proportion to 1 / sqrt(characters), as their means vary more. Documents
above or below their band are rejected.

A null text has no words and fails the base rules, as an empty one does. A null language is one of its own. Repeated
rows each get their verdict. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import ship, stored, text_or_empty

ORDER, CODE_BITS = 5, 10
CODES = 1 << CODE_BITS
#: N-grams that are sent to every executor at most, characters of a unit, and languages whose discounts are broadcast.
MOST_SENT, UNIT_CHARS, MOST_LANGUAGES = 1 << 22, 1 << 25, 10_000
#: Half-width of a band in deviations, the least deviation, and the deviation of one character's log probability.
WIDTH, LEAST_DEVIATION, CHARACTER_DEVIATION = 5.5, 0.02, 2.5
GRID = 10_000
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Odd number whose multiples, modulo 2^64, are the hashes of n-grams: different ones for different n-grams.
SPREAD = 0x9E3779B97F4A7C15


def metrics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
        windows = (ids[:-2] * len(known) + ids[1:-1]) * len(known) + ids[2:] if len(known) < 1 << 20 else None
        if windows is None:  # too many different words for one number
            pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
            windows = pairs[:-1] * len(known) + ids[2:]
        _, of, count = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.concatenate([count[of] > 1, [False, False]])
        repeated = int((twice | np.roll(twice, 1) | np.roll(twice, 2)).sum())
    without = lambda x: len(raw) - len(raw.translate(None, x))
    return n, len(text) - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)), repeated


def grams(text: str):
    """Numbers of the n-grams that end at each character; spaces stand before the text."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(points < CODES // 2, points, CODES // 2 + points % (CODES // 2)).astype(np.int64)
    c = np.concatenate([np.full(ORDER - 1, 32), c])
    n = len(c) - ORDER + 1
    out = c[:n].copy()
    for i in range(1, ORDER):
        out <<= CODE_BITS
        out |= c[i : i + n]
    return out


def counted(docs: DataFrame) -> DataFrame:
    """(model, gram, a, b): how often each n-gram comes in the texts of half 0 and of half 1, over all of docs
    (model, half, text). Summed in each task as it goes, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: dict = {}

        def merged(parts: list):
            keys, of = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(of, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for (model, half), parts in held.items():
                keys, n = merged(parts)
                for at in range(0, len(keys), 50_000):
                    k, m = keys[at : at + 50_000], n[at : at + 50_000]
                    cols = [m, np.zeros_like(m)] if half == 0 else [np.zeros_like(m), m]
                    yield pa.RecordBatch.from_arrays([pa.array([model] * len(k), pa.string()), pa.array(k), *map(pa.array, cols)], ["model", "gram", "a", "b"])
            held.clear()

        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                b, by = whole.slice(start, 1_000), {}
                for model, half, text in zip(b.column("model").to_pylist(), b.column("half").to_pylist(), b.column("text").to_pylist()):
                    if text:
                        by.setdefault((model, half), []).append(grams(text))
                for key, parts in by.items():
                    held.setdefault(key, []).append(np.unique(np.concatenate(parts), return_counts=True))
                    if len(held[key]) > 8:
                        held[key] = [merged(held[key])]
                if sum(len(k) for parts in held.values() for k, _ in parts) > 4_000_000:
                    yield from out()
        yield from out()

    return docs.select("model", "half", "text").mapInArrow(run, "model string, gram long, a long, b long").groupBy("model", "gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << CODE_BITS * order) - 1))


def _discounts(table: DataFrame) -> DataFrame:
    """(model, a1, a2, a3, b1, b2, b3): of counts 1, 2 and 3 or more, from the counts of counts of each half; those of
    the plain method where one of them lacks or they leave their range."""
    sums = table.groupBy("model").agg(*(F.greatest(F.count_if(F.col(x) == i), F.lit(1)).alias(f"{x}{i}") for x in "ab" for i in (1, 2, 3, 4)))
    out = []
    for x in "ab":
        c = [F.col(f"{x}{i}").cast("double") for i in (1, 2, 3, 4)]
        y = c[0] / (c[0] + 2 * c[1])
        for i in (1, 2, 3):
            d = i - (i + 1) * y * c[i] / c[i - 1]
            out.append(F.when((d >= 0.05) & (d < i), d).otherwise(F.least(y, F.lit(0.75))).alias(f"{x}{i}"))
    d = stored(sums.select("model", *out), "discounts")
    return F.broadcast(d) if d.count() <= MOST_LANGUAGES else d


def probabilities(counts: DataFrame) -> DataFrame:
    """(model, gram, a, b): the probability of each n-gram's last character after the others, by the counts of half 0
    and of half 1. Interpolated modified Kneser-Ney; counts: (model, gram, a, b), stored."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # after how many different characters
        longer = tables[n + 1]
        tables[n] = stored(longer.groupBy("model", _suffix(F.col("gram"), n).alias("gram")).agg(F.count_if(F.col("a") > 0).alias("a"), F.count_if(F.col("b") > 0).alias("b")), "lower")
    lower = None
    for n in range(1, ORDER + 1):
        t = tables[n].withColumn("context", F.shiftright("gram", CODE_BITS)).join(_discounts(tables[n]), "model")
        cut = {x: F.when(F.col(x) == 0, 0.0).when(F.col(x) == 1, F.col(f"{x}1")).when(F.col(x) == 2, F.col(f"{x}2")).otherwise(F.col(f"{x}3")) for x in "ab"}
        t = t.select("model", "gram", "context", "a", "b", cut["a"].alias("cut_a"), cut["b"].alias("cut_b"))
        # counts of counts, not sums of discounts, so that the order of rows cannot move a result
        of = lambda x, i: F.count_if(F.col(x) == i) if i < 3 else F.count_if(F.col(x) >= 3)
        least = lambda x, i: F.max(F.when(F.col(x) == i if i < 3 else F.col(x) >= 3, F.col(f"cut_{x}")))
        spare = {x: reduce(lambda p, q: p + q, (of(x, i) * F.coalesce(least(x, i), F.lit(0.0)) for i in (1, 2, 3))) for x in "ab"}
        contexts = t.groupBy("model", "context").agg(*(F.sum(x).alias(f"all_{x}") for x in "ab"), *(spare[x].alias(f"spare_{x}") for x in "ab"))
        t = t.join(contexts, ["model", "context"])
        if lower is None:
            t = t.withColumns({"low_a": F.lit(1 / CODES), "low_b": F.lit(1 / CODES)})
        else:
            low = lower.select("model", F.col("gram").alias("suffix"), F.col("a").alias("low_a"), F.col("b").alias("low_b"))
            t = t.withColumn("suffix", _suffix(F.col("gram"), n - 1)).join(low, ["model", "suffix"])
        p = {x: F.when(F.col(f"all_{x}") > 0, (F.col(x) - F.col(f"cut_{x}") + F.col(f"spare_{x}") * F.col(f"low_{x}")) / F.col(f"all_{x}")).otherwise(F.col(f"low_{x}")) for x in "ab"}
        lower = stored(t.select("model", "gram", p["a"].alias("a"), p["b"].alias("b")), "probabilities")
    return lower


def hashed(gram_numbers):
    import numpy as np

    return gram_numbers.view(np.uint64) * np.uint64(SPREAD)


def sorted_arrays(gram_numbers, a, b) -> tuple:
    """A model as arrays: hashes in order, log probabilities of both halves, and where each value of the hash's
    leading bits begins (some one hash for each value)."""
    import numpy as np

    h = hashed(np.ascontiguousarray(gram_numbers, np.int64))
    by = np.argsort(h)
    h = h[by]
    bits = max(1, len(h).bit_length() - 1)
    starts = np.searchsorted(h >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64)).astype(np.uint32)
    return h, (np.log(np.asarray(a)[by]).astype(np.float32), np.log(np.asarray(b)[by]).astype(np.float32)), starts, bits


def looked_up(model: tuple, gram_numbers, half: int):
    """Log probabilities of n-grams that are all in the model."""
    import numpy as np

    keys, logs, starts, bits = model
    h = hashed(gram_numbers)
    at = starts[h >> np.uint64(64 - bits)]
    wrong = np.nonzero(keys[at] != h)[0]
    while len(wrong):
        at[wrong] += np.uint32(1)
        wrong = wrong[keys[at[wrong]] != h[wrong]]
    return logs[half][at]


def _measure(b, models: dict) -> list:
    """Columns of what is measured of a batch or table (model, half, text)."""
    rows = []
    for model, half, text in zip(b.column("model").to_pylist(), b.column("half").to_pylist(), b.column("text").to_pylist()):
        # a text counts by the other half of the corpus
        mean = -float(looked_up(models[model], grams(text), 1 - half).mean(dtype=float)) if text else None
        rows.append((*metrics(text), len(text), mean))
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 6 + [pa.float64()])]


def _by_model(p: pa.Table) -> dict:
    import pyarrow.compute as pc

    out = {}
    for model in pc.unique(p.column("model")).to_pylist():
        part = p.filter(pc.equal(p.column("model"), model))
        out[model] = sorted_arrays(*(part.column(c).to_numpy() for c in ("gram", "a", "b")))
    return out


def measured(docs: DataFrame, p: DataFrame, most_sent: int = MOST_SENT, unit_chars: int = UNIT_CHARS) -> DataFrame:
    """(doc_id, model, metrics, chars, log_ppl) for each row of docs (doc_id, model, half, text). p: probabilities."""
    spark, names = docs.sparkSession, ["doc_id", "model", *METRICS, "chars", "log_ppl"]
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, model string, {', '.join(f'{m} long' for m in METRICS)}, chars long, log_ppl double"
    if p.count() <= most_sent:
        sent = spark.sparkContext.broadcast(_by_model(p.toArrow()))  # at most MOST_SENT n-grams

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1_000):
                    b = whole.slice(at, 1_000)
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("model"), *_measure(b, sent.value)], names)

        return docs.select("doc_id", "model", "half", "text").mapInArrow(run, schema)

    units = 1 + (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // unit_chars
    dealt = docs.withColumn("unit", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(units)).cast("int"))
    dealt = stored(dealt.select("unit", "doc_id", "model", "half", "text"), "units")  # so that no row changes its unit

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for start in range(0, whole.num_rows, 1_000):
                b, by = whole.slice(start, 1_000), {}
                for unit, model, text in zip(b.column("unit").to_pylist(), b.column("model").to_pylist(), b.column("text").to_pylist()):
                    by.setdefault((unit, model), []).append(grams(text))
                for (unit, model), parts in by.items():
                    k = np.unique(np.concatenate(parts))
                    yield pa.RecordBatch.from_arrays([pa.array([unit] * len(k), pa.int32()), pa.array([model] * len(k), pa.string()), pa.array(k)], ["unit", "model", "gram"])

    needed = dealt.select("unit", "model", "text").mapInArrow(asked, "unit int, model string, gram long").distinct()
    needed = needed.join(p, ["model", "gram"])

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_arrays([left.column("doc_id"), left.column("model"), *_measure(left, _by_model(right))], names)

    return dealt.groupBy("unit").cogroup(needed.groupBy("unit")).applyInArrow(scored, schema)


def _median(values: DataFrame, value: Column, name: str) -> DataFrame:
    """(model, name): the lower median of a column of whole numbers, from sums over its values."""
    counts = values.groupBy("model", value.alias("_v")).agg(F.count("*").alias("_n"))
    order = Window.partitionBy("model").orderBy("_v")
    upto = counts.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy("model")))
    return upto.where("2 * _upto >= _all").groupBy("model").agg(F.min("_v").alias(name))


def judged(docs: DataFrame, width: float = WIDTH, most_sent: int = MOST_SENT, unit_chars: int = UNIT_CHARS) -> DataFrame:
    """doc_id, the metrics, base_failed, kept, log_ppl and the band for each row of docs (doc_id, lang, text)."""
    lang = F.col("lang").cast("string")
    docs = docs.select("doc_id", F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang)).alias("model"), text_or_empty(F.col("text").cast("string")).alias("text"))
    docs = docs.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    p = probabilities(stored(counted(docs), "grams"))
    rows = stored(measured(docs, p, most_sent, unit_chars), "measured")
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    good = rows.where(~F.col("base_failed")).select("model", F.round(F.col("log_ppl") * GRID).cast("long").alias("_ppl"))
    small = lambda x: F.broadcast(x) if x.count() <= MOST_LANGUAGES else x
    centre = small(stored(_median(good, F.col("_ppl"), "_centre"), "centres"))
    spread = _median(good.join(centre, "model"), F.abs(F.col("_ppl") - F.col("_centre")), "_spread")
    bands = small(stored(spread.join(centre, "model").select("model", (F.col("_centre") / GRID).alias("centre"), (1.4826 * F.col("_spread") / GRID).alias("spread")), "bands"))
    half = width * F.sqrt(F.greatest("spread", F.lit(LEAST_DEVIATION)) ** 2 + CHARACTER_DEVIATION**2 / F.greatest("chars", F.lit(1)) / 4)
    out = rows.join(bands, "model", "left").withColumns({"low": F.col("centre") - half, "high": F.col("centre") + half})
    fine = F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(True))
    return out.select("doc_id", *METRICS, "base_failed", (~F.col("base_failed") & fine).alias("kept"), "log_ppl", "low", "high")


ship(sys.modules[__name__])
