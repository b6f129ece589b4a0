"""Texts of a bucket compared with each other exactly, in blocks of bounded size; shared by the near-duplicate operators.

What leaves a task is a spanning forest of the links that it found, never the pairs. Buckets of more than BLOCK_LINES
texts or BLOCK_CHARS characters are dealt into blocks by a hash, and each two blocks of them meet in a task, so no task
holds more than two blocks.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import ship, stored

THRESHOLD = 0.8
#: Most texts and characters of a block.
BLOCK_LINES, BLOCK_CHARS = 256, 1 << 20


def jaccard(x: frozenset[str], y: frozenset[str]) -> float:
    """Of two sets of shingles; 0 where their sizes alone keep them below the threshold."""
    if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
        return 0.0
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def numbered(sets: list[frozenset]) -> list:
    """Sets as sorted arrays of numbers, equal ones for equal members."""
    import numpy as np

    of: dict = {}
    return [np.sort(np.fromiter((of.setdefault(s, len(of)) for s in x), np.uint64, len(x))) for x in sets]


def _near(x, y) -> bool:
    import numpy as np

    a, b = len(x), len(y)
    if min(a, b) < THRESHOLD * max(a, b) - 1e-9:
        return False
    both = np.concatenate((x, y))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1])) * (1 + THRESHOLD) >= THRESHOLD * (a + b) - 1e-9


def forest(left: list, right: list | None = None) -> list[tuple[int, int]]:
    """Links (positions) between sets that connect all similar ones: of one list, or of two that are not compared
    each within itself; then positions count on from the first into the second. Sets are frozensets, or sorted arrays of
    different numbers."""
    import numpy as np

    sets = [*left, *(right or [])]
    if sets and isinstance(sets[0], frozenset):
        sets = numbered(sets)
    m, split = len(sets), len(left)
    start = 1 if right is None else split
    out = [(0, j) for j in range(start, m) if _near(sets[0], sets[j])]
    if len(out) == m - 1 or m == 2:
        return out
    part = np.arange(m)
    part[[j for _, j in out]] = 0
    size = np.array([len(x) for x in sets])
    _, of, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1  # what one set holds alone is in no intersection
    column, members = np.cumsum(shared) - 1, np.split(of, np.cumsum(size)[:-1])
    width = -(-max(1, int(shared.sum())) // 64)
    bits, row = np.empty((m, width), np.uint64), np.zeros(width * 64, bool)
    for i, x in enumerate(members):
        mine = column[x[shared[x]]]
        row[mine] = True
        bits[i] = np.packbits(row).view(np.uint64)
        row[mine] = False
    for i in range(1, m - 1 if right is None else split):
        rest = i + 1 if right is None else split
        others = rest + np.nonzero(part[rest:] != part[i])[0]
        others = others[np.minimum(size[others], size[i]) >= THRESHOLD * np.maximum(size[others], size[i]) - 1e-9]
        if not len(others):
            continue
        both = np.bitwise_count(bits[others] & bits[i]).sum(axis=1, dtype=np.int64)
        for j in others[both * (1 + THRESHOLD) >= THRESHOLD * (size[others] + size[i]) - 1e-9].tolist():
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                out.append((i, j))
    return out


def _linked(groups: DataFrame, sets_of: Callable[[list[str]], list]) -> DataFrame:
    """(a, b): links of each group. groups: (hub, i, j, part, id, line), all rows of (hub, i, j) in a row. Sets are made
    for the texts of some groups at once."""

    def links(held: list[list]) -> Iterator[tuple[int, int]]:
        sets = iter(sets_of([r[5] for rows in held for r in rows]))
        for rows in held:
            mine = [next(sets) for _ in rows]
            halves = [[k for k, r in enumerate(rows) if r[3] == p] for p in dict.fromkeys(rows[0][1:3])]
            ids = [rows[k][4] for half in halves for k in half]
            for a, b in forest(*([mine[k] for k in half] for half in halves)):
                yield ids[a], ids[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            held: list[list] = []
            chars = 0
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    if held and r[:3] == held[-1][0][:3]:
                        held[-1].append(r)
                    else:
                        if chars > 1 << 16:
                            yield from links(held)
                            held, chars = [], 0
                        held.append([r])
                    chars += len(r[5])
            if held:
                yield from links(held)

        found: list = []
        for x in pairs():
            found.append(x)
            if len(found) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return groups.select("hub", "i", "j", "part", "id", "line").mapInArrow(run, "a long, b long")


def linked(rows: DataFrame, texts: DataFrame, sets_of: Callable[[list[str]], list], block_lines: int = BLOCK_LINES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(a, b): links that connect the similar texts of each bucket. rows: (hub, id), stored, the texts of each bucket,
    one of which may have the bucket's number and is then compared first; texts: (id, line), stored; sets_of: the sets of
    shingles of some texts, as sorted arrays of different numbers that are equal for equal shingles of one call."""
    sizes = texts.select("id", F.length("line").alias("chars"))
    parts = F.ceil(F.greatest(F.count("*") / block_lines, F.sum("chars") / block_chars)).cast("int")
    large = stored(rows.join(sizes, "id").groupBy("hub").agg(parts.alias("parts")).where("parts > 1"), "large")
    dealt = rows.join(large, "hub", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("hub", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), "part", "id").join(texts, "id")
    return _linked(dealt.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", F.col("id") != F.col("hub")), sets_of)


ship(sys.modules[__name__])
