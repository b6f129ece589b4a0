"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, union-find; one line stays per component.

A line is compared by its folded form: ASCII lower case, runs of white space as one space, ends stripped. Equal folded
lines share an id (64 bits of hash). Lines of fewer than MIN_CHARS characters have too few shingles for MinHash and are
compared by equality only, those of fewer than ``shortest`` not at all; the query and the pipeline's stage compare all
lines that are not blank. Longer lines whose sets of SHINGLE-character shingles have a Jaccard similarity of at least THRESHOLD are linked; BANDS
bands of ROWS rows find a pair at the threshold with probability 1 - (1 - 0.8**4)**12 = 0.998, and closer ones more
surely. Of each component the line that comes first by (doc_id, line number) stays, all others go.

A bucket is written as one row for each of its lines, (hub, line): the hub is a line that comes often. All lines of one
hub are compared with each other exactly, as sets of bits in blocks (similar.py), so that no pair of a bucket is left
out. Texts of lines travel only if a bucket needs them: the ids that do are set in a bitmap of fixed size that goes
to the scan, and what it lets through in vain falls away in a join.

Documents that lose all their lines that are not blank go; those without any such line stay as they are. Null texts
stay null. Rows that share doc_id and text are one row (the smallest by a hash of its other columns); rows without
doc_id are told apart by their text, and come first. An empty table gives no rows. All columns are kept.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shared import Table, components, is_empty, ship, stored
from vellum.llm.similar import BLOCK_CHARS, BLOCK_LINES, THRESHOLD, forest, jaccard, linked, numbered

__all__ = ["THRESHOLD", "dedup_lines", "forest", "jaccard", "removed", "report", "shingles"]
SHINGLE, MIN_CHARS = 8, 16
BANDS, ROWS = 12, 4
#: Bits of the map of needed ids.
BITMAP = 1 << 26
#: Bytes of a folded text: ASCII letters in lower case, white space but the line feed as spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 11, 12, 13) else c for c in range(256))


def folded_lines(text: bytes) -> list[bytes]:
    """The folded lines of a text in UTF-8, in order."""
    t = text.translate(FOLD)
    while b"  " in t:
        t = t.replace(b"  ", b" ")
    return [x.strip(b" ") for x in t.split(b"\n")]


def folded(line: str) -> str:
    return folded_lines(line.encode("utf-8", "surrogatepass"))[0].decode("utf-8", "surrogatepass")


def shingles(t: str) -> frozenset[str]:
    """A text shorter than a shingle is one itself."""
    return frozenset([t[i : i + SHINGLE] for i in range(max(1, len(t) - SHINGLE + 1))])


def shingle_numbers(lines: list[str]) -> list:
    """The sets of shingles of some lines as sorted arrays of numbers, exact: where the lines have fewer than 256
    different characters a shingle is a number of SHINGLE bytes, else numbers are given out."""
    import numpy as np

    padded = [x.ljust(SHINGLE, "\0") for x in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    known, code = np.unique(points, return_inverse=True)
    if len(known) > 256:
        return numbered([shingles(x) for x in lines])
    code = code.astype(np.uint64)
    n = len(code) - SHINGLE + 1
    packed = code[:n].copy()
    for j in range(1, SHINGLE):
        packed <<= np.uint64(8)
        packed |= code[j : n + j]
    out, at = [], 0
    for x in padded:
        mine = packed[at : at + len(x) - SHINGLE + 1]
        mine = np.sort(mine)
        out.append(mine[np.concatenate(([True], mine[1:] != mine[:-1]))])
        at += len(x)
    return out


def _hashed(lines: list[bytes]):
    import numpy as np
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines)).view(np.int64)


def band_keys(lines: list[str]):
    """Matrix of the lines' bucket numbers, one column a band."""
    import numpy as np

    rng = np.random.default_rng(20)
    turn = rng.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
    move = rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
    out = np.empty((len(lines), BANDS), np.uint64)
    at = 0
    while at < len(lines):
        to, size = at, 0
        while to < len(lines) and (to == at or size < 1 << 15):
            size += len(lines[to])
            to += 1
        part = [x.ljust(SHINGLE) for x in lines[at:to]]
        c = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = np.fromiter(map(len, part), np.int64, len(part))
        h = np.zeros(len(c) - SHINGLE + 1, np.uint32)
        for j in range(SHINGLE):
            h = h * np.uint32(0x01000193) + c[j : len(c) - SHINGLE + 1 + j]
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
        inside = np.ones(len(c), bool)
        ends = np.cumsum(n)
        for j in range(1, SHINGLE):
            inside[ends - j] = False
        h = h[inside[: len(h)]]
        starts = np.concatenate([[0], np.cumsum(n - SHINGLE + 1)[:-1]])
        keys = np.zeros((len(part), BANDS), np.uint64)
        mixed = np.empty_like(h)
        for p in range(BANDS * ROWS):
            np.multiply(h, turn[p], out=mixed)
            np.add(mixed, move[p], out=mixed)
            low = np.minimum.reduceat(mixed, starts).astype(np.uint64)
            band = p // ROWS
            if p % ROWS == 0:
                keys[:, band] = np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            keys[:, band] = (keys[:, band] ^ low) * np.uint64(0xD6E8FEB86659FD93)
            keys[:, band] ^= keys[:, band] >> np.uint64(32)
        out[at:to] = keys
        at = to
    return out.view(np.int64)


def _signatures(docs: DataFrame, shortest: int) -> DataFrame:
    """(doc_id, th, no, id, n, keys) of each line that is compared. keys: its buckets, and n: how often it comes, where
    a line of MIN_CHARS characters or more comes first among the rows that are read together; else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                b = whole.slice(at, 2_000)
                rows, numbers, lines = [], [], []
                for row, t in enumerate(b.column("text").to_pylist()):
                    for no, x in enumerate(folded_lines(t) if t is not None else ()):
                        if x and (len(x) >= 4 * shortest or len(x.decode()) >= shortest):
                            rows.append(row)
                            numbers.append(no)
                            lines.append(x)
                often, first = Counter(lines), {}
                for i, x in enumerate(lines):
                    first.setdefault(x, i)
                new = [(i, t) for x, i in first.items() if len(t := x.decode()) >= MIN_CHARS]
                keys = band_keys([t for _, t in new])
                here = np.zeros(len(lines), np.int64)
                here[[i for i, _ in new]] = BANDS
                offsets = np.concatenate([[0], np.cumsum(here)]).astype(np.int32)
                # keys stand in the order of `first`, which is that of the lines
                buckets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel(), pa.int64()))
                each = pa.array(np.array(rows, np.int64))
                cols = [b.column("doc_id").take(each), b.column("th").take(each), pa.array(numbers, pa.int32()), pa.array(_hashed(lines), pa.int64()), pa.array([often[x] for x in lines], pa.int32()), buckets]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "th", "no", "id", "n", "keys"])

    return docs.select("doc_id", "th", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, th long, no int, id long, n int, keys array<long>")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the given ids (id)."""
    bit = F.pmod(F.col("id"), F.lit(BITMAP)) + 1
    maps = ids.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    sent = docs.sparkSession.sparkContext.broadcast({r["at"]: bytes(r["bits"]) for r in maps.collect()})  # at most BITMAP bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        table = np.zeros(BITMAP // 8, np.uint8)
        for at, bits in sent.value.items():
            table[(at - 1) * 4096 : at * 4096] = np.frombuffer(bits, np.uint8)
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                texts = whole.slice(at, 2_000).column("text").to_pylist()
                lines = list(dict.fromkeys(x for t in texts if t is not None for x in folded_lines(t) if x))
                found = _hashed(lines)
                bit = found % BITMAP
                some = np.nonzero(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)[0]
                yield pa.RecordBatch.from_arrays([pa.array(found[some], pa.int64()), pa.array([lines[i] for i in some], pa.binary()).cast(pa.string())], ["id", "line"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "id long, line string").join(ids, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line"))


def _edges(docs: DataFrame, signatures: DataFrame, block_lines: int = BLOCK_LINES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(a, b): links that connect similar lines."""
    members = signatures.where("keys is not null").select(F.explode("keys").alias("key"), "id", "n")
    hub = F.max(F.struct("n", "id")).over(Window.partitionBy("key"))["id"]
    pairs = stored(members.select(hub.alias("hub"), "id").where("id != hub").distinct(), "pairs")
    rows = pairs.union(pairs.select("hub", F.col("hub").alias("id")).distinct())
    texts = stored(_texts(docs, rows.select("id").distinct()), "texts")
    return linked(rows, texts, shingle_numbers, block_lines, block_chars)


def removed(docs: DataFrame, shortest: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, gone): the numbers of the lines that go, for each document with any. docs has th."""
    table = Table(_signatures(docs, shortest), "signatures")
    edges = stored(_edges(docs, table.df), "edges")
    labels = components(edges).select(F.col("node").alias("id"), "component")
    lines = table.df.select("doc_id", "th", "no", "id")
    several = lines.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    # a line without links is a group of its own, under the number that components() would give it
    groups = several.join(labels, "id", "full").select("id", F.coalesce("component", F.xxhash64("id")).alias("group"))
    hits = stored(lines.join(groups, "id").select("doc_id", "th", "no", "group"), "hits")
    place = F.struct("doc_id", "th", "no")
    keepers = stored(hits.groupBy("group").agg(F.min(place).alias("keeper")), "keepers")
    gone = hits.join(keepers, "group").where(~place.eqNullSafe(F.col("keeper")))
    out = stored(gone.groupBy("doc_id", "th").agg(F.collect_set("no").alias("gone")), "gone")
    table.drop()
    return out


def _without(text: Column, gone: Column) -> Column:
    """text without the lines of the numbers gone. The outer function of one list binds the lines, so that the text
    is split once."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.get(F.transform(F.array(lines), lambda x: F.transform(kept, lambda i: F.get(x, i))), F.lit(0)), "\n")


def dedup_lines(docs: DataFrame, shortest: int = MIN_CHARS) -> DataFrame:
    """docs without repeated lines, and without the documents that consist of such lines only."""
    names = [f"`{c}`" for c in docs.columns]
    text = F.col("text").cast("string")
    gone = removed(docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th")), shortest)
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.xxhash64(text).alias("t"))
    rows = docs.select(key.alias("at"), F.struct(*map(F.col, names)).alias("row"))
    repeated = stored(rows.groupBy("at.d", "at.t").agg(F.count("*").alias("n")).where("n > 1").select(F.struct("d", "t").alias("at")), "repeated")
    if not is_empty(repeated):
        order = F.xxhash64(*(F.col(f"row.{c}").cast("string") for c in names))
        one = rows.join(repeated, "at", "left_semi").groupBy("at").agg(F.min_by("row", order).alias("row"))
        rows = rows.join(repeated, "at", "left_anti").union(one)
    gone = gone.select(F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.col("th").alias("t")).alias("at"), "gone")
    whole = F.col("row.text").cast("string")
    out = rows.join(gone, "at", "left").select("row", "gone", F.when(F.col("gone").isNull(), whole).otherwise(_without(whole, F.col("gone"))).alias("kept"))
    out = out.where(F.col("gone").isNull() | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*(F.col("kept").alias("text") if c == "`text`" else F.col(f"row.{c}").alias(c[1:-1]) for c in names))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) for each row that dedup_lines keeps, all lines compared that are not blank."""
    before = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("n_lines", F.size(F.split("text", "\n", -1)))
    out = dedup_lines(before, shortest=1)
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), (F.col("n_lines") - F.size(F.split("text", "\n", -1))).cast("long").alias("n_removed"), "text")


ship(sys.modules[__name__])
