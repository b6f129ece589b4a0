"""The operators on small tables, against brute force, with nulls, empty tables, repeats and extra columns."""

import zlib

import pytest

from vellum.llm import line_classifier, line_dedup, mixing, packing, quality_rules, secret_scan, sharding, simhash, topk, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string"
LONG = " ".join(f"word{i % 97}x{i}" for i in range(5_000))
BASE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of stars and moonlight in an old kettle"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, BASE, "en", "a", 1, "x"), (2, BASE.upper(), "en", "a", 1, "x"), (3, None, "en", None, None, None), (4, "", None, "b", 0, None), (5, LONG, "en", "b", 1, ""),
        (6, "one", "en", "b", 3, ""), (6, "one", "en", "b", 3, ""), (None, "no id but some words here", "fr", "b", 3, ""), (8, "é ü\n\n ß", "de", "c", 3, ""), (9, " \t\n", "de", "c", 3, ""),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_simhash_against_brute_force(docs, none):
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [simhash.fingerprint(t) for _, t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    first = {g: min((d for k, (d, _) in enumerate(texts) if group[k] == g and d is not None), default=None) for g in group}
    assert found == {(d, f"{f:016x}", first[g]) for (d, _), f, g in zip(texts, fps, group)}
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_links_every_pair_within_three_bits(spark):
    import random

    r = random.Random(1)
    fps = [r.getrandbits(64) for _ in range(150)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), k)) for f in fps for k in (1, 2, 3, 4)]
    signed = [f - (1 << 64) if f >> 63 else f for f in set(fps)]
    got = {frozenset((x.a, x.b)) for x in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & mask).bit_count() <= 3}


def test_simhash_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id is not None) == [(False, d) for d in (1, 3, 5, 6, 8)]


def test_line_dedup(spark, none):
    line = "A line of text that is long enough to be looked at by the operator, with more words."
    near = line.replace("words.", "words!")
    rows = [(1, f"{line}\nshort"), (2, f"own words of the second document stay here\n{near}"), (3, line.upper()), (4, None), (5, ""), (6, "short\nshort"), (7, LONG), (7, LONG)]
    df = spark.createDataFrame([(a, b, "g") for a, b in rows], "doc_id long, text string, gone string")
    got = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()}
    assert line_dedup.jaccard(line_dedup.shingles(line_dedup.folded(line)), line_dedup.shingles(line_dedup.folded(near))) >= 0.8
    assert got == {(1, rows[0][1]), (2, "own words of the second document stay here"), (4, None), (5, ""), (6, "short\nshort"), (7, LONG)}
    assert line_dedup.dedup_lines(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    from vellum.llm.shared import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups: dict = {}
    for r in got:
        groups.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 160))]


def test_urls(spark):
    urls = [None, "no host", "http://A.example.org/es/1?x#y", "https://example.com/fr/", "https://x.com/de/1", "http://example.org/en/12", "ftp://net", "https://a.net/" + "p/" * 3_000, "https://a.net/1", "https://a.net/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judged(df).collect()}
    assert (got[0].host, got[0].path, got[0].rule) == ("", "", None)
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (got[3].rule, got[4].rule, got[5].rule) == ("com/fr/", "com/de/", "example.org/en/1")
    assert (got[6].host, got[6].path) == ("net", "") and {r.verdict for r in got.values()} == {"allow", "block"}
    assert got[8].score == got[9].score
    assert url_filter.judged(df.where("page_id < 0")).count() == 0


def test_trees_learn():
    rows = [[float(i % 7), float(i % 11)] for i in range(400)]
    labels = [int(a > 3) for a, _ in rows]
    t = url_filter.Trees.fit(rows, labels)
    assert sum((t.raw(r) >= 0) == y for r, y in zip(rows, labels)) == 400


def test_sharding(docs, none):
    got = sharding.assign(docs).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in got}
    assert sizes[3] == (16, 0) and sizes[1] == (16 + len(BASE), zlib.crc32(BASE.encode()))
    assert sharding.assign(none).count() == 0


def test_sharding_by_weight(spark):
    ids = spark.range(4_000).withColumnRenamed("id", "doc_id")
    n = {r.shard: r["count"] for r in sharding.rendezvous(ids, "doc_id", 3, [1.0, 1.0, 2.0], grown=None).groupBy("shard").count().collect()}
    assert abs(n[2] - 2_000) < 150 and abs(n[0] - 1_000) < 150


def test_secrets(spark, none):
    live, copied = "Zq8xTr5vLm2nBw9cKj4hYd7p", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8"
    rows = [(i, f"é copy {copied} end", f"s{i}") for i in range(4)] + [(9, f'ü Password: "hunter22" and {live} AKIAABCDEFGH1234 ' + "0f" * 16, "s1"), (10, None, None), (11, "", "s"), (12, "token: secret: abcdefgh1", "s")]
    df = spark.createDataFrame([(a, b, c, 0) for a, b, c in rows], "doc_id long, text string, source string, spans int")
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    assert (got[9].n_assign, got[9].n_access, got[9].n_hex) == (1, 1, 1)
    assert got[9].spans.split(",")[0] == "assign:2:21" and "mixed:27:51" in got[9].spans
    assert got[0].spans == "" and got[0].n_example == 1 and got[10].spans == "" and got[12].n_assign == 0
    assert secret_scan.scan(none).count() == 0


def test_secrets_of_one_owner_in_many_repositories(spark):
    copied, own = "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8", "Zq8xTr5vLm2nBw9cKj4hYd7p"
    rows = [(i, f"copy {copied} end" + (f" {own}" if i == 3 else ""), "hot") for i in range(secret_scan.EXAMPLE_REPOSITORIES + 1)]
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].spans == "" and (got[0].most_owners, got[0].most_repositories) == (1, len(rows))
    assert got[3].spans == "mixed:34:58" and (got[3].n_live, got[3].n_example) == (1, 1)


def test_secrets_of_a_text_with_very_many(spark):
    """Places against the regular expressions of Python, in a text with more matches than are summed in one go."""
    import re
    import time

    text = "".join(f"é{i} " + ("AKIA%016d x" % i if i % 2 else "token=%08d " % i) for i in range(20_000))
    began = time.time()
    got = secret_scan.scan(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    want = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)] + [(m.start(), 0, m.end()) for m in re.finditer("token=[A-Za-z0-9+/_.=-]+", text)]
    names = ["assign", "access"]
    assert got.spans == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(want)) and time.time() - began < 60


def test_quality_metrics():
    assert quality_rules.metrics("") == (0, 0, 0, 0, 0)
    assert quality_rules.metrics("a b c a b c") == (6, 6, 0, 0, 6)
    assert quality_rules.metrics("x # é\n\nx # é\n x # é") == (9, 9, 3, 1, 9)
    words = [str(i) for i in range(50)]
    assert quality_rules.metrics(" ".join(words))[4] == 0


def test_quality_rules(docs, none):
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect() if r.doc_id is not None}
    assert got[3].base_failed and not got[3].kept and not got[5].base_failed
    assert quality_rules.judged(none).count() == 0


def test_mixing(spark, none):
    rows = [(i, "w " * (5 + i % 3), "big" if i < 90 else "small", 0) for i in range(100)] + [(200, None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")
    got = mixing.mix(df, block=7).collect()
    seen = {r.doc_id for r in got}
    assert seen == {r[0] for r in rows}
    tokens = {s: sum(r.n_tokens for r in got if r.source == s) for s in ("big", "small")}
    assert all(r.passes <= mixing.REPEATS + 1e-6 for r in got) and tokens["small"] > 3.8 * 60
    passes: dict = {}
    for r in got:
        passes.setdefault((r.source, r.epoch), []).append((r.position, r.doc_id))
    # each pass is a permutation: gapless places, no document twice, another order each time
    for places in passes.values():
        assert sorted(p for p, _ in places) == list(range(len(places))) and len({d for _, d in places}) == len(places)
    orders = {k: [d for _, d in sorted(v)] for k, v in passes.items() if k[0] == "small" and len(v) == 10}
    assert len(orders) >= 3 and len(set(map(tuple, orders.values()))) == len(orders)
    # each source gets its budget, but for less than a document
    for s in ("big", "small"):
        assert 0 <= tokens[s] <= next(r.passes for r in got if r.source == s) * sum(5 + i % 3 for i in (range(90) if s == "big" else range(90, 100))) + 1e-6
    clash = df.withColumnsRenamed({"epoch": "_times"})
    assert mixing.mixed(clash, block=7).columns == clash.columns and mixing.mixed(clash, block=7).count() == len(got)
    assert mixing.mixed(df, block=7).columns == df.columns
    assert mixing.mix(none).count() == 0


def test_mixing_entropy(spark):
    totals = spark.createDataFrame([("a", 1, 1000), ("b", 1, 100), ("c", 1, 10)], "source string, docs long, tokens long")
    a = mixing.exponent(totals, None, 0.9)
    h = mixing._powers(totals)[0](a)[1] / 1.0986122886681098
    assert abs(h - 0.9) < 1e-6


def test_topk_against_brute_force(spark):
    import random

    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(8)]) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(60)] + [(1_000, None), (1_050, [None] * 8), (1_100, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in topk.neighbours(df).collect()}
    from math import floor

    q = {i: [floor(256 * x) for x in v] for i, v in rows if v and None not in v and v[0] == v[0]}
    want = {}
    for a in (i for i in q if i % 50 == 0):
        best = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)[:5]
        want |= {(a, k + 1): (b, -s) for k, (s, b) in enumerate(best)}
    assert got == want
    assert topk.neighbours(df.where("vec_id < 0")).count() == 0


def test_topk_of_large_and_uneven_vectors(spark):
    rows = [(0, [1e7, -1.0, 3.0]), (1, [1e7, 2.0]), (2, [-1e7, 1.0, 1.0]), (3, [1e300, 0.0, 0.0]), (3, [1e300, 0.0, 0.0]), (4, [0.25, 0.5]), (5, []), (50, [-1.0, 1e7]), (None, [1.0])]
    df = spark.createDataFrame([(a, b, 7) for a, b in rows], "vec_id long, embedding array<double>, query_id int")
    got = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in topk.neighbours(df, k=3).collect()}
    from math import floor

    top = (1 << 63) - 1
    q = {i: [max(-(1 << 63), min(top, floor(256 * x))) for x in v] for i, v in rows if i is not None}
    for a in (0, 50):
        best = sorted((-max(-top + 1, min(top, sum(x * y for x, y in zip(q[a], q[b])))), b) for b in q if b != a)[:3]
        assert [got[a, k] for k in (1, 2, 3)] == [(b, -s) for s, b in best]


def test_cover_tree_holds_its_rows():
    import numpy as np

    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.3, (400, 3)) for c in (0, 5, 9)])
    t = topk.CoverTree(points, 20)
    for node, (lo, hi) in enumerate(t.span):
        rows = t.points[t.order[lo:hi]]
        assert np.sqrt(((rows - t.centre[node]) ** 2).sum(axis=1)).max() <= t.radius[node] + 1e-9
        kids = t.children[node]
        assert not kids or (sorted(t.span[k] for k in kids)[0][0] == lo and sum(t.span[k][1] - t.span[k][0] for k in kids) == hi - lo and (t.centre[kids] == t.centre[node]).all(axis=1).any())


def test_packing(docs, none):
    got = packing.pack(docs).collect()
    full: dict = {}
    for r in got:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in full.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_vocabulary())
    ids = t.encode(LONG, add_special_tokens=False).ids + [0]
    mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 5)
    assert mine == [(k, a, len(ids[a : a + 2048]), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a : a + 2048]))) for k, a in enumerate(range(0, len(ids), 2048))]
    assert sum(r.length for r in got if r.doc_id in (3, 4)) == 2 and packing.pack(none).count() == 0


def test_packing_search_gains():
    import random

    r = random.Random(2)
    lengths = [r.randint(300, 1_300) for _ in range(600)]
    bins = packing.Bins(2048)
    bins.best_fit(list(enumerate(lengths)))
    before = len(bins.items)
    bins.search()
    assert sum(map(bool, bins.items)) < before and sorted(x for b in bins.items for x in b) == sorted((n, i) for i, n in enumerate(lengths))


def test_classifier(spark, docs, none):
    good = [(i, f"This is sentence number {i} of a fine document.\nIt goes on for a while, and ends well.", 1) for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i} $$$ ### &&&\n*** CHEAP!! %%%", 0) for i in range(60)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    got = line_classifier.scored(df.drop("quality"), df.select("doc_id", "quality")).collect()
    assert all(r.predicted == (r.doc_id < 100) and 0 <= r.score <= 1 for r in got) and any(r.held_out for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unlabelled = line_classifier.scored(docs, df.select("doc_id", "quality").where("doc_id < 0")).collect()
    assert len(unlabelled) == docs.count() and all(r.score == pytest.approx(0.5) for r in unlabelled)
    assert line_classifier.scored(none, df.select("doc_id", "quality")).count() == 0


def test_classifier_on_held_out_documents(spark):
    """Accuracy and order of scores on documents that the fit has not seen, against the share of the larger class."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = line_classifier.scored(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert len(got) > 80 and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got) > max(len(good), len(bad))
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_classifier_fits_all_lines_of_a_document(spark):
    """Two kinds of documents that differ only after many lines."""
    head = "\n".join(f"the same line {i} of all documents" for i in range(70))
    rows = [(i, head + "\n" + "\n".join(["### $$$ !!! 9999"] * 70 if i % 2 else ["a quiet sentence of plain words"] * 70)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_classifier.scored(df, df.selectExpr("doc_id", "1 - doc_id % 2 AS quality")).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)
    few = line_classifier.train(df, df.selectExpr("doc_id", "1 - doc_id % 2 AS quality"), fit_lines=300)
    assert few.weights.any()


def test_classifier_keeps_columns_of_clashing_names(spark):
    good = [(i, f"This is sentence number {i} of a fine document.\nIt goes on for a while, and ends well.", b"x", {"a": 1}) for i in range(40)]
    bad = [(100 + i, f"BUY!! NOW!! {i} $$$ ### &&&\n*** CHEAP!! %%%", None, None) for i in range(40)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, _bytes binary, _quality map<string,int>")
    labels = spark.createDataFrame([(r[0], int(r[0] < 100)) for r in good + bad] + [(1, 1), (101, 1), (102, None)], "doc_id long, quality int")
    kept = line_classifier.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in good}


def test_simhash_keeps_one_of_repeated_rows_with_maps(spark):
    df = spark.createDataFrame([(1, "one two three", {"a": 1}), (1, "one two three", {"a": 1}), (2, "one two three", None), (None, None, None)], "doc_id long, text string, more map<string,int>")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0, r.more or {}) for r in kept.collect()) == [(0, {}), (1, {"a": 1})]


def test_forward_backward_against_enumeration():
    from itertools import product
    from math import exp

    import numpy as np

    chain = line_classifier.Chain(np.zeros(3), np.array([[0.4, -0.3], [-0.2, 0.6]]))
    odds = [0.7, -1.1, 0.2, 2.0]
    total, good = 0.0, [0.0] * 4
    for y in product((0, 1), repeat=4):
        p = exp(sum(o * v for o, v in zip(odds, y)) + sum(chain.pairs[a, b] for a, b in zip(y, y[1:])))
        total += p
        good = [g + p * v for g, v in zip(good, y)]
    assert chain.marginals(odds) == pytest.approx([g / total for g in good])
