"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has 64 bits in four segments of 16, on a ring. If two fingerprints differ in at most 3 bits, then
some segment starts a chain whose first j segments together differ in at most floor(3 j / 4) bits, for each j
from 1 to 4: in 0, 1, 2 and 3. So a pair is looked up by one segment that is equal and the next one with at most
one bit flipped (a key of 32 bits), is pruned by the chain of three, and only then meets the full check.

That is the query; the stage of the pipeline, keep_one(), links texts whose sets of shingles of WORDS words have a
Jaccard similarity of THRESHOLD or more. Its candidates come by the same filter from two fingerprints of single words,
pruned by a sketch of their shingles.

Null and empty texts, and those of white space only, have fingerprint zero and link like any others. Rows with
a null doc_id are kept; they link texts, but never name a component unless it has no other row (then null).
Repeated rows stay repeated. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import Table, components, ship, stored
from vellum.llm.similar import THRESHOLD, linked, numbered

__all__ = ["THRESHOLD", "keep_one", "near_duplicates"]
SEGMENTS, WIDTH = 4, 16
MAX_BITS = 3
#: Words of a shingle in the exact comparison of the pipeline's stage, and numbers of a text's sketch.
WORDS, SKETCH_BANDS = 5, 6
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Shingles whose bits are counted at a time; bounds the memory of very long texts.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text as an unsigned number."""
    import numpy as np
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = [b" ".join(x) for x in zip(*(found[i:] for i in range(words)))]
    of, total, votes = xxhash.xxh64_intdigest, len(shingles), np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = shingles[at : at + CHUNK]
        h = np.fromiter((of(s, 42) for s in part), np.uint64, len(part))
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, words) for t in b.column("text").to_pylist()]
            signed = pa.array([x - (1 << 64) if x >> 63 else x for x in fps], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), signed], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): the pairs of different fingerprints at most three bits apart. distinct: one row (fp) for each."""
    fp = F.col("fp")
    key = lambda i, nxt: F.shiftleft(F.lit(i).cast("long"), 2 * WIDTH).bitwiseOR(F.shiftleft(_segment(fp, i), WIDTH)).bitwiseOR(nxt)
    flips = [0, *(1 << k for k in range(WIDTH))]
    held = distinct.select(fp.alias("a"), F.posexplode(F.array(*(key(i, _segment(fp, i + 1)) for i in range(SEGMENTS)))).alias("i", "k"))
    asked = distinct.select(fp.alias("b"), F.explode(F.array(*(key(i, _segment(fp, i + 1).bitwiseXOR(F.lit(f).cast("long"))) for i in range(SEGMENTS) for f in flips))).alias("k"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # the chain of three is all but the segment before the first one
    last = F.expr(f"shiftrightunsigned(a ^ b, pmod(i + {SEGMENTS - 1}, {SEGMENTS}) * {WIDTH}) & {(1 << WIDTH) - 1}L")
    chain = F.bit_count(apart) - F.bit_count(last) <= MAX_BITS * 3 // SEGMENTS
    # Spark sizes an exploded side as what it was before, and might broadcast it; a merge join it can split
    found = held.hint("merge").join(asked, "k").where((F.col("a") < F.col("b")) & chain & (F.bit_count(apart) <= MAX_BITS))
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text)."""
    prints = stored(fingerprints(docs), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    edges = Table(links(distinct), "links")
    labels = Table(components(edges.df), "labels")
    named = labels.df.join(distinct, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("first").alias("smallest"))
    named = stored(named, "named")
    of = stored(labels.df.join(named, "component").select(F.col("node").alias("fp"), "smallest"), "of")
    of = stored(distinct.join(of, "fp", "left").select("fp", F.coalesce("smallest", "first").alias("component_id")), "of")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def word_prints(text: str) -> tuple[int, int]:
    """Two SimHashes of a text's single words, each as often as it comes, from the halves of one hash of 128 bits."""
    import numpy as np
    import xxhash

    count = Counter(text.encode("utf-8", "surrogatepass").translate(LOWER).split())
    if not count:
        return 0, 0
    raw = b"".join(map(xxhash.xxh3_128_digest, count))
    n, total = np.fromiter(count.values(), np.int64, len(count)), sum(count.values())
    votes = np.zeros(128, np.int64)
    for at in range(0, len(count), CHUNK):
        part = np.frombuffer(raw[16 * at : 16 * (at + CHUNK)], np.uint8).reshape(-1, 16)
        votes += n[at : at + CHUNK] @ np.unpackbits(part, axis=1).astype(np.int64)
    both = np.packbits(votes * 2 > total).tobytes()
    return int.from_bytes(both[:8], "big", signed=True), int.from_bytes(both[8:], "big", signed=True)


def word_shingles(text: str) -> frozenset[str]:
    """Sets of WORDS words of a text in lower case (ASCII), or the whole of a shorter one."""
    words = [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").translate(LOWER).split()]
    return frozenset(" ".join(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1)))


def sketch(text: str) -> list[int]:
    """A number for each of SKETCH_BANDS pairs of least hashes of a text's shingles of WORDS words. Texts at a similarity
    of 0.8 share one with probability 1 - (1 - 0.64)**6 = 0.998, texts without common shingles none."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    h = np.fromiter({xxhash.xxh64_intdigest(b" ".join(words[i : i + WORDS])) for i in range(max(1, len(words) - WORDS + 1))}, np.uint64)
    turn = np.random.default_rng(5).integers(1, 1 << 63, 2 * SKETCH_BANDS, dtype=np.uint64) | np.uint64(1)
    least = np.array([(h * t).min() for t in turn]).reshape(SKETCH_BANDS, 2)
    mixed = (least[:, 0] ^ (least[:, 1] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + least[:, 1] + np.arange(SKETCH_BANDS, dtype=np.uint64)
    return mixed.view(np.int64).tolist()


def similar_texts(docs: DataFrame) -> DataFrame:
    """(a, b): links that connect all texts found similar, by a hash of each text. docs: (th, text).

    Candidates are texts with a SimHash of their words at most MAX_BITS apart, found by the pigeonring filter, and
    chains of them; single words change less by an edit than shingles do, so these fingerprints find most pairs at the
    threshold. Long texts of one language have near fingerprints without being copies, so only texts take part that
    share a number of their sketch with another text, and only those of a chain that share one are compared: exactly,
    as sets of shingles of WORDS words, at a Jaccard similarity of THRESHOLD. Rows stay linear in the texts: each has
    two fingerprints and SKETCH_BANDS numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                b = whole.slice(at, 1_000)
                texts = b.column("text").to_pylist()
                found = [word_prints(t) for t in texts]
                cols = [*(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)), pa.array([sketch(t) for t in texts], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column("th"), *cols], ["th", "p0", "p1", "keys"])

    prints = docs.mapInArrow(run, "th long, p0 long, p1 long, keys array<long>")
    prints = stored(prints.groupBy("th").agg(F.first("p0").alias("p0"), F.first("p1").alias("p1"), F.first("keys").alias("keys")), "prints")
    keys = prints.select("th", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    keys = stored(keys.join(shared, "key"), "shared")
    some = stored(prints.join(keys.select("th").distinct(), "th", "left_semi").select("th", "p0", "p1"), "some")
    rows = None
    for i in (0, 1):
        held = some.select(F.col(f"p{i}").alias("fp"), "th")
        chains = components(stored(links(stored(held.select("fp").distinct(), "distinct")), "links"))
        mine = held.join(chains.withColumnRenamed("node", "fp"), "fp", "left").select("th", F.coalesce("component", F.xxhash64("fp")).alias("chain"))
        mine = mine.join(keys, "th").select(F.xxhash64("chain", "key", F.lit(i)).alias("hub"), F.col("th").alias("id"))
        rows = mine if rows is None else rows.union(mine)
    rows = stored(rows.distinct(), "buckets")
    several = rows.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    rows = stored(rows.join(several, "hub", "left_semi"), "buckets")
    texts = docs.select(F.col("th").alias("id"), F.col("text").alias("line")).join(rows.select("id").distinct(), "id", "left_semi")
    texts = stored(texts.groupBy("id").agg(F.min("line").alias("line")), "texts")
    return linked(rows, texts, lambda some: numbered([word_shingles(t) for t in some]))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs without all but one of each group of near-duplicates: texts that are equal, or linked by
    similar_texts(). The row with the smallest doc_id stays, and of several the one with the smallest hash of its
    columns as text. Null and empty texts, and those of white space only, are one group. Rows without doc_id stay, and
    stand for no group."""
    names = [f"`{c}`" for c in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = F.when(text.rlike(r"[^\x20\x09-\x0D]"), text).otherwise("")
    named = docs.where("doc_id is not null")
    keys = stored(named.select("doc_id", F.xxhash64(plain).alias("th")), "texts")
    some = named.select(F.xxhash64(plain).alias("th"), plain.alias("text")).where("text != ''")
    labels = components(stored(similar_texts(some), "links")).select(F.col("node").alias("th"), "component")
    grouped = keys.groupBy("th").agg(F.min("doc_id").alias("first")).join(labels, "th", "left").select("first", F.coalesce("component", F.xxhash64("th")).alias("group"))
    keep = grouped.groupBy("group").agg(F.min("first").alias("doc_id")).select("doc_id").distinct()
    order = F.xxhash64(*(F.col(c).cast("string") for c in names))
    kept = docs.join(keep, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*map(F.col, names)), order).alias("_row"))
    return kept.select(*(F.col(f"_row.{c}").alias(c[1:-1]) for c in names)).unionByName(docs.where("doc_id is null"))


ship(sys.modules[__name__])
