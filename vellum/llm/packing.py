"""Packing of tokenised documents into sequences: best fit, then a swap-based local search.

A document is its tokens and an end token. Only a document longer than a sequence is cut, into full pieces and a
last one that may be shorter. Pieces are dealt into groups of some GROUP by their stored row number, so that equal
rows spread; each group is packed by itself, which leaves at most about one sequence more than needed in each.

Best fit decreasing gives the first packing. The search then takes the emptiest sequences in turn and moves mass
out of them: it moves a piece, exchanges it for a smaller one, for two smaller ones, or two for one, always into a
fuller sequence, so that the sum of squared fills grows; a sequence that runs empty is gone.

A null text is an empty one: a piece of the end token only. Null and repeated doc_ids are packed like others.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import ship, stored, text_or_empty

CAPACITY = 2048
END = (0).to_bytes(4, "little")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Pieces packed together, and words whose tokens a worker remembers.
GROUP, REMEMBER = 40_000, 1_200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Tokens of a text as bytes (little-endian, 32 bits), put together from those of its words.

    The tokenizer never joins characters across ASCII white space and drops it, so a text's tokens are those of
    its words in turn; it folds case, and cuts between letters and punctuation, so a word of letters and a tail of
    punctuation are looked up apart, in ASCII lower case. Words met before are remembered, up to a bound, as long as the
    worker lives.
    Letters not met before are encoded many at a time; the tokens that end a word cut the result again.
    """

    TAIL = ".,;:!?*&%$#|"

    def __init__(self, vocabulary: str):
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.letters = Tokenizer.from_file(vocabulary), {}, {}
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[n for t, n in vocab.items() if t.endswith("</w>")]] = True

    @classmethod
    def of_worker(cls, vocabulary: str) -> Words:
        held = vars(sys).setdefault("_vellum_words", {})
        if vocabulary not in held:
            held[vocabulary] = cls(vocabulary)
        return held[vocabulary]

    def _plain(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.asarray(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn_letters(self, texts: list[bytes]) -> None:
        import numpy as np

        for at in range(0, len(texts), 1024):
            part = texts[at : at + 1024]
            ids = np.asarray(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            cuts = (np.nonzero(self.ends[ids])[0] + 1).tolist()
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                raw = ids.tobytes()
                self.letters.update([(w, raw[4 * a : 4 * b]) for w, a, b in zip(part, [0, *cuts], cuts)])
            else:
                self.letters.update(zip(part, self._plain([w.decode() for w in part])))

    def learn(self, words: set[bytes]) -> None:
        """words: in ASCII lower case."""
        split, rest, tail = [], [], self.TAIL.encode()
        for w in words:
            core = w.rstrip(tail)
            if core.isalpha():  # ASCII letters only
                split.append((w, core, w[len(core) :]))
                continue
            text = core.decode()
            if text.isalpha() and unicodedata.is_normalized("NFC", text) and "\u03a3" not in text and "\u0130" not in text:
                split.append((w, text.lower().encode(), w[len(core) :]))
            else:
                rest.append(w)
        letters = self.letters
        self._learn_letters([c for c in {c for _, c, _ in split} if c not in letters])
        tails = [t for t in {t for _, _, t in split} if t]
        of = dict(zip(tails, self._plain([t.decode() for t in tails]))) | {b"": b""}
        self.known.update([(w, letters[c] + of[t]) for w, c, t in split])
        self.known.update(zip(rest, self._plain([w.decode() for w in rest])))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Many texts at once: what is new in about a million bytes of those that hold something new is learnt in one go."""
        out: list[bytes] = [b""] * len(texts)
        waiting: list[tuple[int, list[bytes]]] = []
        size = 0

        def catch_up() -> None:
            new = {w for _, words in waiting for w in words if w not in self.known}
            if len(self.known) + len(new) > REMEMBER:
                self.known, self.letters = {}, {}
                new = {w for _, words in waiting for w in words}
            self.learn(new)
            for i, words in waiting:
                out[i] = b"".join(map(self.known.__getitem__, words))
            waiting.clear()

        for i, t in enumerate(texts):
            words = t.translate(LOWER).split()
            try:
                out[i] = b"".join(map(self.known.__getitem__, words))
            except KeyError:
                waiting.append((i, words))
                size += len(t)
                if size > 1 << 20:
                    catch_up()
                    size = 0
        catch_up()
        return out


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = Words.of_worker(vocabulary or default_vocabulary())
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc, ids in zip(b.column("doc_id").to_pylist(), words.encode_all(b.column("text").to_pylist())):
                ids += END
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for c, x in zip(cols, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text")).mapInArrow(run, PIECES)


class Bins:
    """Sequences that hold pieces, by their lengths. Equal lengths are alike until the end."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.free = capacity, [], []

    def best_fit(self, lengths) -> None:
        by_free: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_ = 0  # bit f: some sequence has f tokens free
        for piece, n in lengths:
            fits = open_ >> n
            if fits:
                f = n + (fits & -fits).bit_length() - 1
                k = by_free[f].pop()
                if not by_free[f]:
                    open_ &= ~(1 << f)
                self.items[k].append((n, piece))
            else:
                f, k = self.capacity, len(self.items)
                self.items.append([(n, piece)])
                self.free.append(f)
            self.free[k] = f - n
            by_free[f - n].append(k)
            open_ |= 1 << (f - n)

    def search(self, failures: int = 12, width: int = 128) -> None:
        """Move mass out of the emptiest sequences into `width` underfull ones that are fuller, until the number of
        sequences is the least that the tokens need, or `failures` sources in turn let nothing go."""
        least = -(-sum(self.capacity - f for f in self.free) // self.capacity)
        left, tried = sum(map(bool, self.items)), set()
        while left > least and len(tried) < failures:
            under = sorted((k for k, f in enumerate(self.free) if self.items[k] and f), key=lambda k: -self.free[k])
            source = next((k for k in under if k not in tried), None)
            if source is None:
                return
            into = [k for k in under if self.free[k] < self.free[source] or (self.free[k] == self.free[source] and k > source)][:width]
            moved = False
            while self.items[source] and self._move(source, into):
                moved = True
            left -= not self.items[source]
            tried = set() if not self.items[source] else tried | {source}
            if moved and self.items[source]:
                tried &= {source}

    def _exchange(self, a: int, out: list, b: int, back: list) -> bool:
        gain = sum(n for n, _ in out) - sum(n for n, _ in back)
        for x in out:
            self.items[a].remove(x)
        for x in back:
            self.items[b].remove(x)
        self.items[a] += back
        self.items[b] += out
        self.free[a] += gain
        self.free[b] -= gain
        return True

    def _move(self, a: int, into: list[int]) -> bool:
        """One move or exchange that takes tokens from a to a fuller sequence: the one that fills it best."""
        import numpy as np

        mine = sorted(self.items[a], reverse=True)
        for p in mine:
            if fit := [b for b in into if self.free[b] >= p[0]]:
                return self._exchange(a, [p], min(fit, key=lambda b: self.free[b]), [])
        backs = [(b, [q]) for b in into for q in self.items[b]]
        ones = len(backs)
        backs += [(b, [q, r]) for b in into for i, q in enumerate(self.items[b][:8]) for r in self.items[b][i + 1 : 8]]
        if not backs:
            return False
        size = np.fromiter((sum(n for n, _ in x) for _, x in backs), np.int64, len(backs))
        room = np.fromiter((self.free[b] for b, _ in backs), np.int64, len(backs))
        outs = [([p], len(backs)) for p in mine] + [([x, y], ones) for i, x in enumerate(mine[:12]) for y in mine[i + 1 : 12]]
        best: tuple | None = None
        for out, n in outs:
            gain = sum(n for n, _ in out) - size[:n]
            gain = np.where(gain <= room[:n], gain, 0)
            k = int(gain.argmax())
            if gain[k] > 0 and (best is None or gain[k] > best[0]):
                best = (gain[k], out, k)
        return best is not None and self._exchange(a, best[1], *backs[best[2]])


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(sequence, offset) for each length."""
    bins = Bins(capacity)
    bins.best_fit(sorted(enumerate(lengths), key=lambda x: -x[1]))
    bins.search()
    out = [(0, 0)] * len(lengths)
    for number, items in enumerate(x for x in bins.items if x):
        at = 0
        for n, piece in items:
            out[piece] = (number, at)
            at += n
    return out


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces of docs (doc_id, text) with their place: sequence_id and offset."""
    cut = stored(pieces(docs, vocabulary, capacity).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = 1 + cut.count() // group

    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "_row"]).reset_index(drop=True)
        places = pack_group(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = [(int(g) << 32) + s for g, (s, _) in zip(pdf["_group"], places)]
        pdf["offset"] = [at for _, at in places]
        return pdf.drop(columns=["_group", "_row"])

    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, PIECES + ", sequence_id long, offset long")


ship(sys.modules[__name__])
