"""Edit distances of many pairs of texts at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of 64 rows that are worked on at once; one pair may have more.
WORDS = 8192
_PAD, _TOP = b"\x00", np.uint64(63)


def _block(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Distances of pairs (longer, shorter) in which neither is empty.

    Myers' vectors of differences, a column of the table for each character of the shorter text, a bit for each of the
    longer. Word w of a pair is one column behind word w - 1, whose last horizontal difference it takes, so all words of
    all pairs take a step together. Both texts get the same end, which leaves the distance, so that rows fill their words."""
    pads = [-len(a) % 64 for a, _ in pairs]
    words = np.array([(len(a) + p) // 64 for (a, _), p in zip(pairs, pads)])
    columns = np.array([len(b) + p for (_, b), p in zip(pairs, pads)])
    order = np.argsort(-(columns + words), kind="stable")
    pairs, pads, words, columns = [pairs[i] for i in order], [pads[i] for i in order], words[order], columns[order]

    longer = np.frombuffer(b"".join(a + _PAD * p for (a, _), p in zip(pairs, pads)), np.uint8)
    # a word waits for its first column, and goes on after the last one without effect: code 0 equals no row
    shorter = np.frombuffer(b"".join(b + _PAD * p for (_, b), p in zip(pairs, pads)), np.uint8)
    total, ends = int(words.sum()), np.cumsum(words)
    first = ends - words
    known = np.flatnonzero(np.bincount(longer, minlength=256))
    code = np.zeros(256, np.int64)
    code[known] = np.arange(1, len(known) + 1) * total
    equal = np.zeros((len(known) + 1, total), np.uint64)
    for row, c in zip(equal[1:], known):
        row[:] = np.packbits(longer == c, bitorder="little").view(np.uint64)
    equal = equal.ravel()

    text = np.zeros(int((columns + 2 * (words - 1)).sum()), np.int64)
    text_start = np.cumsum(columns + 2 * (words - 1)) - columns - (words - 1)
    text[np.repeat(text_start - (np.cumsum(columns) - columns), columns) + np.arange(len(shorter))] = code[shorter]
    word = np.arange(total)
    at = np.repeat(text_start, words) - (word - np.repeat(first, words))

    steps = columns + words - 1
    active = ends[np.searchsorted(-steps, -np.arange(1, steps[0] + 1), side="right") - 1]
    positive, negative, score = np.full(total, ~np.uint64(0)), np.zeros(total, np.uint64), np.zeros(total, np.uint64)
    # horizontal differences that a word takes, one place further for those that it gives
    up, down = np.zeros(total + 1, np.uint64), np.zeros(total + 1, np.uint64)
    is_first = np.zeros(total + 1, np.uint64)
    is_first[first] = 1
    inner = np.uint64(1) - is_first
    index, eq, xv, ph, mh = np.empty(total, np.int64), *(np.empty(total, np.uint64) for _ in range(4))
    width, views = 0, ()
    for k in active:
        if k != width:
            width, views = k, tuple(v[:k] for v in (at, word, index, eq, xv, ph, mh, positive, negative, score, up, down, is_first, inner))
            up_out, down_out = up[1 : k + 1], down[1 : k + 1]
        at_, word_, i, e, x, p, m, pv, mv, sc, hp, hm, one, rest = views
        text.take(at_, out=i, mode="wrap")
        i += word_
        equal.take(i, out=e, mode="wrap")
        at_ += 1
        np.bitwise_and(hp, rest, out=hp)
        np.bitwise_or(hp, one, out=hp)
        np.bitwise_and(hm, rest, out=hm)
        np.bitwise_or(e, mv, out=x)
        np.bitwise_or(e, hm, out=e)
        np.bitwise_and(e, pv, out=m)
        np.add(m, pv, out=m)
        np.bitwise_xor(m, pv, out=m)
        np.bitwise_or(m, e, out=m)
        np.bitwise_or(m, pv, out=p)
        np.invert(p, out=p)
        np.bitwise_or(p, mv, out=p)
        np.bitwise_and(m, pv, out=m)
        np.left_shift(p, 1, out=mv)
        np.bitwise_or(mv, hp, out=mv)
        np.left_shift(m, 1, out=pv)
        np.bitwise_or(pv, hm, out=pv)
        np.right_shift(p, _TOP, out=up_out)
        np.right_shift(m, _TOP, out=down_out)
        sc += up_out
        sc -= down_out
        np.bitwise_or(x, mv, out=p)
        np.invert(p, out=p)
        np.bitwise_or(pv, p, out=pv)
        np.bitwise_and(mv, x, out=mv)
    out = np.empty(len(pairs), np.int64)
    out[order] = words * 64 + score[ends - 1].view(np.int64)
    return out


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distance of each text of a and its one of b, all of ASCII."""
    out, todo = np.zeros(len(a), np.int64), []
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            x, y = (x, y) if len(x) >= len(y) else (y, x)
            if y:
                todo.append((len(y) + len(x) // 64, i, x.encode("ascii"), y.encode("ascii")))
            else:
                out[i] = len(x)
    todo.sort(key=lambda t: -t[0])
    block, words = [], 0
    for k, t in enumerate(todo):
        block.append(t)
        words += len(t[2]) // 64 + 1
        if words >= WORDS or k + 1 == len(todo):
            out[[t[1] for t in block]] = _block([t[2:] for t in block])
            block, words = [], 0
    return out


def edit_distance(a: Column, b: Column) -> Column:
    """Edit distance of two columns of ASCII texts, in words of bits: the engine's own takes a step for each pair of characters."""

    @F.pandas_udf("int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series(distances(x.tolist(), y.tolist()))

    return run(a, b)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
