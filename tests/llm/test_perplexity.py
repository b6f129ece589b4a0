"""The language model against a plain one in dictionaries, its two ways of scoring, and the verdicts."""

import random
from collections import Counter, defaultdict
from math import log, sqrt

import pytest

from vellum.llm import quality_rules as qr
from vellum.llm.shared import stored

WORDS = {"en": "ship sail storm worn house wood deck men slept under stars with cold hands and bread".split(), "fr": "une jolie maquette bleue qui bouge beaucoup avec quelques voiles blanches au vent".split()}


def prose(lang: str, n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    out = [(i, lang, prose(lang, 80, i)) for i, lang in enumerate(["en", "fr"] * 15)]
    r = random.Random(0)
    out += [(100, "en", " ".join("".join(chr(r.randrange(33, 0x300)) for _ in range(6)) for _ in range(70))), (101, "fr", prose("en", 80, 1000)), (102, None, prose("fr", 60, 1001)), (103, "en", ""), (104, "en", None)]
    out += [(105, "en", out[0][2]), (105, "en", out[0][2]), (None, "fr", "é" * 400 + " " + prose("fr", 60, 3)), (106, "en", "short text"), (107, "en", "many words " * 60)]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(a, b, c, 0) for a, b, c in rows], "doc_id long, lang string, text string, centre int")


def plain_probabilities(counts: Counter) -> dict:
    """Interpolated modified Kneser-Ney of all n-grams (tuples) that `counts` names, from their counts."""
    tables = {qr.ORDER: counts}
    for n in range(qr.ORDER - 1, 0, -1):
        longer, t = tables[n + 1], Counter()
        for g, c in longer.items():
            t[g[1:]] += c > 0
        tables[n] = t
    p = {(): 1 / qr.CODES}
    for n in range(1, qr.ORDER + 1):
        t, now = tables[n], {}
        c = [max(1, sum(v == i for v in t.values())) for i in (1, 2, 3, 4)]
        y = c[0] / (c[0] + 2 * c[1])
        d = [0.0] + [x if 0.05 <= (x := i - (i + 1) * y * c[i] / c[i - 1]) < i else min(y, 0.75) for i in (1, 2, 3)]
        total, spare = defaultdict(int), defaultdict(float)
        for g, v in t.items():
            total[g[:-1]] += v
            spare[g[:-1]] += d[min(v, 3)]
        for g, v in t.items():
            h = g[:-1]
            now[g] = (v - d[min(v, 3)] + spare[h] * p[g[1:]]) / total[h] if total[h] else p[g[1:]]
        p = now
    return p


def plain_codes(text: str) -> list[tuple]:
    c = [32] * (qr.ORDER - 1) + [o if (o := ord(x)) < 512 else 512 + o % 512 for x in text]
    return [tuple(c[i : i + qr.ORDER]) for i in range(len(text))]


def test_log_perplexity_and_verdicts_against_plain_version(spark, rows, table):
    halves = {r.text: r.half for r in table.selectExpr("text", "pmod(xxhash64(coalesce(text, '')), 2) AS half").collect()}
    counted: dict = defaultdict(lambda: (Counter(), Counter()))
    for _, lang, text in rows:
        for g in plain_codes(text or ""):
            counted[lang][halves[text]][g] += 1
            counted[lang][1 - halves[text]][g] += 0
    p = {lang: [plain_probabilities(c) for c in both] for lang, both in counted.items()}
    want = {}
    for d, lang, text in rows:
        g = plain_codes(text or "")
        want[d, lang, text] = -sum(log(p[lang][1 - halves[text]][x]) for x in g) / len(g) if g else None
    got = [(r.doc_id, r) for r in qr.judged(table).collect()]
    assert len(got) == len(rows)
    by_id = {d: r for d, r in got}
    for (d, _, _), w in want.items():
        assert by_id[d].log_ppl == (None if w is None else pytest.approx(w, abs=1e-5))
    # bands and verdicts
    for lang in ("en", "fr", None):
        mine = [(d, t, w) for (d, x, t), w in want.items() if x == lang]
        failed = {d: by_id[d].base_failed for d, _, _ in mine}
        values = sorted(round(by_id[d].log_ppl * qr.GRID) for d, x, t in rows if x == lang and not by_id[d].base_failed)
        lower = lambda v: sorted(v)[(len(v) + 1) // 2 - 1]
        centre = lower(values)
        spread = 1.4826 * lower([abs(v - centre) for v in values]) / qr.GRID
        for d, t, w in mine:
            half = qr.WIDTH * sqrt(max(spread, qr.LEAST_DEVIATION) ** 2 + qr.CHARACTER_DEVIATION**2 / max(1, len(t or "")) / 4)
            assert by_id[d].kept == (not failed[d] and (w is None or abs(by_id[d].log_ppl - centre / qr.GRID) <= half))
    assert not by_id[100].kept and not by_id[100].base_failed and not by_id[101].kept
    assert by_id[0].kept and by_id[1].kept and by_id[106].base_failed and by_id[107].base_failed and by_id[103].base_failed
    assert {r.centre for r in [table.first()]} == {0} and qr.judged(table.where("doc_id < 0")).count() == 0


def test_both_ways_of_scoring_are_equal(table):
    key = lambda r: (r.doc_id is None, r.doc_id)
    sent, joined = (sorted(qr.judged(table, most_sent=m, unit_chars=2_000).collect(), key=key) for m in (qr.MOST_SENT, 0))
    assert sent == joined


def test_no_gram_is_dropped_and_probabilities_sum_to_one(spark):
    import numpy as np

    text = "the cat sat on the mat and the dog sat on the log " * 200
    df = spark.createDataFrame([("en", 0, text)] * 20 + [("en", 0, "zqxj"), ("en", 1, "the cat")], "model string, half int, text string")
    counts = stored(qr.counted(df), "grams")
    p = {r.gram: r for r in qr.probabilities(counts).collect()}
    assert set(qr.grams(text).tolist()) | set(qr.grams("zqxj").tolist()) == set(p) and counts.agg({"a": "sum"}).first()[0] == 20 * len(text) + 4
    seen = [g for g in p if g >> qr.CODE_BITS == int(qr.grams("he c")[-1]) & ((1 << 40) - 1)]
    assert seen and sum(p[g].a for g in seen) < 1 and np.isclose(sum(p[g].a for g in seen), 1, atol=0.05)
