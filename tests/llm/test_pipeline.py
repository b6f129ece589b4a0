"""The pipeline's stages against brute force, on whole small tables, odd rows and none."""

import pytest
from test_line_dedup import brute

import corpus_pipeline
from vellum.llm import line_classifier, mixing, packing, simhash
from vellum.llm.shared import stored

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and result, by its name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, SF), name)
        out[name] = (docs, made)
        docs = made
    return out


def similar(texts: dict) -> dict:
    """The group of each id: shingles of five words, Jaccard 0.8 or more, every pair compared; ids of equal groups alike."""
    sets = {d: simhash.word_shingles(t) for d, t in texts.items() if (t or "").split()}
    group = {d: d for d in texts}
    blank = [d for d in texts if d not in sets]
    for d in blank:
        group[d] = min(blank)
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {d: lo if g == hi else g for d, g in group.items()}
    return group


def test_columns_and_sizes(steps):
    for name, (before, after) in steps.items():
        assert name == "sequences" or after.columns == before.columns
    sizes = [after.count() for _, after in steps.values()]
    assert sizes[0] >= sizes[1] >= sizes[2] <= sizes[3] <= sizes[4]


def test_quality_against_the_scores(steps, spark):
    before, after = steps["quality"]
    scores = line_classifier.scored(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.score >= 0.5}


def test_lines_against_brute_force(steps):
    before, after = steps["lines"]
    assert {r.doc_id: r.text for r in after.collect()} == brute([(r.doc_id, r.text) for r in before.collect()])


def test_near_duplicates_against_brute_force(steps, spark):
    before, after = steps["near_duplicates"]
    group = similar({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == {d for d, g in group.items() if d == g}
    # the documents as they are hold more copies
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    group = similar({r.doc_id: r.text for r in docs.collect()})
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept >= {d for d, g in group.items() if d == g} and len(kept - {d for d, g in group.items() if d == g}) <= 0.1 * sum(d != g for d, g in group.items())


def test_mixture_against_its_budgets(steps):
    before, after = steps["mixture"]
    tokens = lambda t: len((t or "").split())
    have, rows, took = {}, {}, {}
    for r in before.collect():
        have[r.source] = have.get(r.source, 0) + tokens(r.text)
        rows[r.doc_id] = r
    for r in after.collect():
        assert rows[r.doc_id] == r
        took.setdefault(r.source, {}).setdefault(r.doc_id, []).append(tokens(r.text))
    passes = {s: sum(map(sum, took[s].values())) / have[s] for s in have if have[s]}
    assert set(took) == set(have) and {d for x in took.values() for d in x} == set(rows)
    assert max(passes.values()) <= mixing.REPEATS + 1e-9 and min(passes.values()) == pytest.approx(1)
    for s, n in passes.items():  # whole passes, and one that is cut
        assert {len(x) for x in took[s].values()} <= {int(n), int(n) + 1, int(n + 1e-9)}


def test_sequences_against_the_tokenizer(steps):
    from tokenizers import Tokenizer

    before, after = steps["sequences"]
    t = Tokenizer.from_file(packing.default_vocabulary())
    want = sorted((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in before.collect())
    got, full = {}, {}
    for r in after.collect():
        got.setdefault(r.doc_id, []).append(r.length)
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = {d: n for d, n in want}
    assert all(sum(got[d]) == n * sum(x == d for x, _ in want) for d, n in lengths.items()) and got.keys() == lengths.keys()
    for places in full.values():
        ends = [0, *(a + n for a, n in sorted(places))]
        assert [a for a, _ in sorted(places)] == ends[:-1] and ends[-1] <= packing.CAPACITY
    assert len(full) <= -(-sum(n for _, n in want) // packing.CAPACITY) + 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_none(spark, tmp_path, name):
    labels = spark.createDataFrame([(1, 1, None), (None, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _bytes binary, _times int, _row map<string,int>, gone string, position int, fp long"
    long = "words of a very long text " * 4_000
    rows = [
        (None, None, None, None, None, None, None, None, None, None, None), (1, "a text", "en", "a", 6, b"", 1, {}, "", 0, 0), (1, "a text", "en", "a", 6, b"", 1, {}, "", 0, 0),
        (2, "", "en", None, 0, b"", 1, {"a": 1}, "", 0, 0), (3, long, "en", "b", 1, b"x", 2, None, "", 0, 0), (4, long, "en", "b", 1, b"x", 2, None, "", 0, 0), (None, "no id", "de", "b", 1, None, 2, None, "", 0, 0),
    ]
    df = spark.createDataFrame(rows, kinds)
    for docs in (df, df.where("n_chars < 0")):
        out = STAGES[name](spark, docs, str(tmp_path))
        got = out.collect()
        assert name == "sequences" or out.columns == docs.columns
        assert (len(got) > 0) == (docs is df)


def test_near_duplicates_of_few_changed_words(spark):
    """Recall of copies with few words changed, all of which have a similarity of 0.8 or more."""
    import random

    r = random.Random(7)
    texts = [x.text for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect() if 150 <= len((x.text or "").split()) <= 600][:120]
    rows, pairs = [], []
    for i, t in enumerate(texts):
        words = t.split()
        for k in r.sample(range(len(words)), 2):
            words[k] = f"changed{r.randrange(1000)}"
        copy = " ".join(words)
        a, b = simhash.word_shingles(t), simhash.word_shingles(copy)
        rows += [(2 * i, t), (2 * i + 1, copy)]
        pairs += [(2 * i, 2 * i + 1)] if len(a & b) >= 0.8 * len(a | b) else []
    kept = {x.doc_id for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(pairs) > 100 and sum(b not in kept for _, b in pairs) >= 0.95 * len(pairs)
