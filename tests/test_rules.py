"""Hand-made documents for the rules, and properties of parsers and scalars."""

import io
import zipfile

import pytest

from vellum.functions import text
from vellum.operators import align, sections, sequence
from vellum.sources import markup
from vellum.sources.storage import shared_path, write_stage

LINE = "doc_id long, pdf_idx int, text string, page int, font_size int, predicted int, ncols int, line_x0 int, line_y0 int, line_x1 int"


def lines(spark, rows):
    """rows: (text, class) or (text, class, page, font)."""
    full = [(1, i, r[0], r[2] if len(r) > 2 else 0, r[3] if len(r) > 3 else 10, r[1], 1, 72, 10 * i, 500) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, LINE)


def repaired(spark, *rows):
    return [r.final for r in sequence.repair(lines(spark, rows)).orderBy("pdf_idx").collect()]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("Contents", 0), ("x", 0)], [2, 0]),
        ([("a . . . . . 3", 0)], [4]),
        ([("1 Scope 12", 0), ("1 12", 0)], [4, 0]),
        ([("1 a 2", 0), ("x", 1), ("2 b 3", 0)], [4, 4, 4]),
        ([("a", 2), ("b", 3, 0, 12), ("c", 0)], [2, 2, 0]),
        ([("a", 2), ("b", 0), ("c", 3), ("d", 0)], [2, 3, 3, 0]),
        ([("a", 2), ("b", 3), ("c", 0, 1)], [2, 2, 0]),
        ([("x", 2), ("a", 3), ("b", 1), ("c", 0)], [2, 3, 3, 0]),
        ([("x", 2), ("a", 3), ("b", 1), ("c", 1)], [2, 3, 0, 1]),
        ([("[#x2014;] item", 0), ("x", 0)], [10, 0]),
        ([("a", 4), ("b", 1), ("c", 0)], [4, 1, 0]),
        ([("a", 2), ("b", 1), ("c", 0)], [2, 3, 0]),
    ],
)
def test_repair(spark, rows, want):
    assert repaired(spark, *rows) == want


def test_classes_that_are_not_predicted_pass_through(spark):
    assert repaired(spark, ("t", 5), ("a", 0), ("h", 6)) == [5, 0, 6]


def merged(spark, *rows):
    out = sequence.merge_lines(lines(spark, rows), "predicted").orderBy("pdf_idx").collect()
    return [(r.text, r.cls) for r in out]


def test_merge(spark):
    assert merged(spark, ("a", 0), ("b", 1), ("c", 1)) == [("abc", 0)]
    assert merged(spark, ("t", 4), ("lost", 1), ("a", 0)) == [("t", 4), ("a", 0)]
    assert merged(spark, ("a", 0), ("b", 1, 1)) == [("a", 0), ("b", 0)]
    assert merged(spark, ("a", 0), ("head", 6), ("b", 1)) == [("ab", 0), ("head", 6)]
    assert merged(spark, ("a", 12), ("b", 12)) == [("a", 12), ("b", 12)]
    assert merged(spark, ("head", 6, 1), ("b", 1, 1)) == [("head", 6)]


def test_sections(spark):
    df = lines(spark, [("intro", 0), ("One", 2), ("more", 3), ("body", 0), ("Two", 2), ("text", 1)])
    got = [(r.heading, r.content) for r in sections.sections(df).orderBy("section").collect()]
    assert got == [("Introduction", "intro"), ("One - more", "body"), ("Two", "text")]


def test_chunks_rejoin(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, " ".join(map(str, range(300)))), (2, ""), (3, "  a \n b ")], "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.chunks(F.col("t"), 128).alias("c")).collect()}
    assert [len(c.split()) for c in got[1]] == [128, 128, 44] and " ".join(got[1]) == " ".join(map(str, range(300)))
    assert got[2] == [] and got[3] == ["a b"]


def test_html_traps():
    html = '<h2>T</h2><script>var t="</p>"</script><p>one <b>two<p class="footnote">n</p><!-- <p>no</p> --><nav><p>menu</p></nav>'
    assert markup.html_blocks(html) == [("h2", 2, "T"), ("p", 0, "one two"), ("p", 8, "n")]
    assert markup.html_blocks(None) == []


def test_xml_and_latex():
    assert markup.xml_blocks("<a><HD>Head</HD><x><P>one <E>two</E></P></x></a>") == [("HD", 2, "Head"), ("P", 0, "one two")]
    assert markup.xml_blocks("<a>") == []
    got = markup.latex_blocks("\\section{A \\textbf{b}}\nText % note\n\n\\begin{itemize}\\item one\\item \\emph{two}\\end{itemize}")
    assert got == [("section", 2, "A b"), ("par", 0, "Text"), ("item", 10, "one"), ("item", 10, "two")]


def test_docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t, s="": f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{p('Head', 'Heading1')}{p('Body')}<w:tbl><w:tr><w:tc>{p('Cell')}</w:tc></w:tr></w:tbl>{p('1 Intro', 'TOC1')}</w:body></w:document>")
        z.writestr("word/header1.xml", f"<w:hdr {w}>{p('Top')}</w:hdr>")
    assert [(c, t) for _, c, t in markup.docx_blocks(b.getvalue())] == [(2, "Head"), (0, "Body"), (5, "Cell"), (4, "1 Intro"), (6, "Top")]


def test_distances():
    assert align.edit_distance("kitten", "sitting") == 3 and align.edit_distance("", "ab") == 2
    assert align.common_subsequence("abcde", "ace") == 3
    assert align.partial_ratio("lo wo", "hello world") == 100.0 and align.ratio("ab", "ab") == 100.0


def test_alignment_uses_a_place_once():
    got = align.align_document([(0, "same words here"), (1, "same words here")], [(7, "same words here and more"), (8, "then same words here again")])
    assert [(n, x) for n, x, *_ in got] == [(0, 7), (1, 8)]


def test_stage_is_skipped_when_present(spark):
    path = shared_path(spark, "stage")
    assert write_stage(spark.range(3).toDF("id"), path).count() == 3
    assert write_stage(spark.range(9).toDF("id"), path).count() == 3
    assert write_stage(spark.range(9).toDF("id"), path, overwrite=True).count() == 9


def test_null_rules(spark):
    from pyspark.sql import functions as F

    from vellum.functions.layout import change, ternary

    df = spark.createDataFrame([(None, None), (1, None), (2, 1), (1, 2), (3, 3)], "a int, b int")
    assert [(r.t, r.c) for r in df.select(ternary(F.col("a"), F.col("b")).alias("t"), change(F.col("a"), F.col("b")).alias("c")).collect()] == [(0, 1), (1, 1), (1, 1), (-1, 1), (0, 0)]


def test_partial_matches_against_all_windows():
    import random

    from vellum.operators import align

    r = random.Random(4)
    words = ["the", "regulation", "applies", "before", "after", "it", "to", "each", "part", "of", "this", "section"]
    seen = [0, 0]
    for _ in range(400):
        a = " ".join(r.choice(words) for _ in range(r.randint(1, 6)))
        b = " ".join(r.choice(words) for _ in range(r.randint(1, 14)))
        if r.random() < 0.6:  # a piece of the longer text with some letters changed
            at = r.randrange(len(b))
            a = "".join(c if r.random() > 0.12 else r.choice("abcdefg ") for c in b[at : at + r.randint(1, 40)])
        want = align.partial_ratio(a, b) > align.MATCH
        assert align.matches(a, b) == want == align.matches(b, a), (a, b)
        seen[want] += 1
    assert min(seen) > 80
    assert align.matches("", "") and not align.matches("", "x") and align.matches("x", "xyz")


def test_partial_join_in_both_directions(spark):
    from vellum.operators import align

    turns = [(1, 0, "the regulation applies before and after it"), (1, 1, "applies before"), (1, 2, "zzz"), (2, 0, "ab")]
    texts = spark.createDataFrame(turns, "doc_id long, pdf_idx int, text string")
    items = spark.createDataFrame([(1, 5, "regulation applies"), (1, 6, "aplies before and"), (2, 1, "xaby"), (2, 0, "ab")], "doc_id long, item_id int, item string")
    got = {(r.doc_id, r.pdf_idx): r.item_id for r in align.partial_join(texts, items).collect()}
    assert got == {(1, 0): 6, (1, 1): 6, (2, 0): 1}


def test_older_rules_against_a_walk():
    import random

    from vellum.operators.sequence import older_classes

    def walk(c: list) -> list:
        c = list(c)
        for i in range(len(c)):
            now, before = c[i], c[i - 1] if i else None
            if i == 0 or i == len(c) - 1:
                if now == 3 and before not in (2, 3):
                    c[i] = 2
                continue
            after = c[i + 1]
            if before == 4 and after == 4 and now != 2:
                c[i] = 4
            if before not in (2, 3) and now == 3:
                c[i] = 2
            if before in (2, 3) and now == 1 and after in (0, 1):
                c[i] = 0 if after == 1 else 3
        return c

    r = random.Random(8)
    for _ in range(500):
        c = [r.randrange(5) for _ in range(r.randint(1, 9))]
        assert older_classes(c) == walk(c)


def test_missing_columns_are_an_error(spark):
    import pytest

    from vellum import schema

    df = spark.range(1).selectExpr("id AS a")
    assert schema.require(df, ["a"]) is df
    with pytest.raises(ValueError, match="b"):
        schema.require(df, ["a", "b"])


def test_window_ratios_against_each_window():
    import random

    from vellum.operators import align

    r = random.Random(6)
    for _ in range(150):
        long = "".join(r.choice("abcd") for _ in range(r.randint(1, 30)))
        short = "".join(r.choice("abcde") for _ in range(r.randint(1, len(long))))
        n = len(short)
        want = [align.ratio(short, long[max(0, at) : at + n]) for at in range(1 - n, len(long))]
        assert align.window_ratios(short, long).tolist() == want


def test_windows_against_a_walk():
    import random

    from vellum.operators.windows import window_bounds

    r = random.Random(2)
    for _ in range(300):
        words = [r.choice((0, 1, 2, 5, 9)) for _ in range(r.randint(0, 25))]
        size, overlap = r.randint(1, 20), r.randint(0, 10)
        found = window_bounds(words, size, overlap)
        assert bool(found) == bool(words) and (not words or found[-1][1] == len(words) - 1)
        for (a, b, n), later in zip(found, [*found[1:], None]):
            assert n == sum(words[a : b + 1]) and sum(words[a:b]) < size and (n >= size or b == len(words) - 1)
            if later:
                assert a < later[0] <= b + 1
                assert sum(words[later[0] : b + 1]) <= overlap or later[0] == a + 1
                assert later[0] - 1 <= a or sum(words[later[0] - 1 : b + 1]) > overlap


def test_edit_distance_against_the_table():
    import random

    from vellum.operators import align

    r = random.Random(5)
    for _ in range(200):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 90))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert align.edit_distance(a, b) == row[-1]


def test_alignment_of_a_document():
    from vellum.operators import align

    text = [f"line number {i} speaks of the {w} and of nothing else at all" for i, w in enumerate("harbour mountain kettle garden window carpet button market forest ladder".split())]
    blocks = [(10 + k, " ".join(text[2 * k : 2 * k + 2])) for k in range(5)]
    lines = [(i, t) for i, t in enumerate(text)]
    lines[4] = (4, text[4].replace("nothing", "nothimg"))
    lines += [(10, "contents 12", "Contents .......... 12"), (11, "x"), (12, "words that stand in no block whatever"), (13, "1 " + text[9], "1. " + text[9])]
    got = align.align_document(lines, blocks)
    assert [(n, x) for n, x, *_ in got] == [(i, 10 + i // 2) for i in range(10)] + [(10, None), (11, None), (12, None), (13, None)]
    # the second line of each block begins where the first one ends; an equal line is not matched where it is used up
    assert all(got[i][3] == (0 if i % 2 == 0 else len(text[i - 1]) + 1) for i in range(10)) and got[4][2] < 1 == got[5][2]
    assert align.align_document(lines, [])[0] == (0, None, 0.0, 0, 0)


def test_windows_lead_to_the_right_blocks():
    """A long text whose other version has other blocks before it and in its middle: windows follow it."""
    import random

    from vellum.operators import align

    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    text = [" ".join(r.choice(vocabulary) for _ in range(10)) for _ in range(230)]
    more = [" ".join(r.choice(vocabulary) for _ in range(10)) for _ in range(80)]
    blocks = list(enumerate(more[:40] + text[:110] + more[40:] + text[110:]))
    got = align.align_document(list(enumerate(text)), blocks)
    right = sum(x == i + (40 if i < 110 else 80) for i, x, *_ in got)
    assert right >= 0.95 * len(text), right


def test_best_place_against_all_places():
    import random

    from vellum.operators import align

    r = random.Random(12)
    words = "alpha beta gamma delta to of in regulation part section it".split()
    hits = 0
    for _ in range(200):
        block = " ".join(r.choice(words) for _ in range(r.randint(3, 25)))
        at = r.randrange(len(block))
        line = "".join(c if r.random() > 0.1 else r.choice("xyz ") for c in block[at : at + r.randint(4, 50)]).strip() or "x"
        used = align.Used()
        used.take(0, 0, r.randint(0, 10))
        places = [(s, min(len(block), s + len(line))) for s in [0, *(i + 1 for i, c in enumerate(block) if c == " ")]]
        whole = [i for i in range(len(block)) if block.startswith(line, i) and used.free(0, i, i + len(line))]
        free = [(1 - align.edit_distance(line, block[s:e]) / len(line), -s, e) for s, e in places if used.free(0, s, e)]
        want = (1.0, -whole[0], whole[0] + len(line)) if whole else max((f for f in free if f[0] >= 0.75), key=lambda f: (f[0], f[1]), default=(0.0, 0, 0))
        sim, s, e = align.best_place(line, block, used, 0, 0.75)
        assert (round(sim, 9), s, e) == (round(want[0], 9), -want[1], want[2])
        hits += sim > 0
    assert hits > 50


def test_equal_words_are_not_compared_place_by_place(monkeypatch):
    from vellum.operators import align

    calls = []
    distance = align.edit_distance
    monkeypatch.setattr(align, "edit_distance", lambda a, b: calls.append(1) or distance(a, b))
    line = "Oure " * 200 + "station"
    assert align.best_place(line, line.replace("tion", "shun"), align.Used(), 0, 0.75)[1:] == (0, len(line)) and len(calls) < 5


def test_windows_by_pieces_are_those_of_all_windows():
    import random

    from vellum.operators import align

    r = random.Random(8)
    words = ["station", "the", "regulation", "applies", "before", "after", "it", "each", "part", "of", "this", "section"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    found = 0
    for _ in range(60):
        b = text(60)
        at = r.randrange(300)
        a = "".join(c if r.random() > 0.08 else "#" for c in b[at : at + 120]) if r.random() < 0.7 else text(20)
        for most in (70.0, 80.0):
            proved = align.window_above(a, b, most)
            assert not proved or align.partial_ratio(a, b) > most
            found += proved
    assert found > 10


def test_far_texts_are_not_combed_and_matches_end_the_search(spark, monkeypatch):
    import random

    from vellum.operators import align

    r = random.Random(9)
    text = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 9))) for _ in range(60))
    monkeypatch.setattr(align, "strands", lambda a, b: 1 / 0)
    a, b = text("abcdefghijklm"), text("efghijklmnopq")
    assert not align.matches(a, b) and align.matches(a, a.replace("a", "z"))
    texts = spark.createDataFrame([(1, i, a) for i in range(40)], "doc_id long, pdf_idx int, text string")
    items = spark.createDataFrame([(1, i, a if i < 30 else b) for i in range(40)], "doc_id long, item_id int, item string")
    plan = align.partial_join(texts, items)
    assert [r.item_id for r in plan.collect()] == [29] * 40 and "Sort" in plan._jdf.queryExecution().toString()


def test_bins_on_edges_are_those_of_the_sql(spark, tmp_path):
    import random

    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from vellum.plans import QUERIES, SQL

    r = random.Random(2)
    texts = ["\n".join("x" * r.choice(v) for _ in range(r.randint(2, 10))) for v in ((1, 1 + r.randrange(1, 40)) for _ in range(3_000))]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    got = {tuple(x) for x in QUERIES["bin_features"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.sql(f"create view documents as from '{tmp_path}/documents.parquet'")
    assert got == set(c.sql(SQL["bin_features"]).fetchall())


def test_fits_read_a_stored_sample(spark):
    from vellum.operators import models
    from vellum.sources.tables import lines_of

    frame = models.feature_frame(lines_of(spark, "/root/testdata/sf0.001"))
    sample = models.fit_sample(frame, 50)
    assert sample.count() == 50 and all("fit-sample" in f for f in sample.inputFiles())


def test_folds_are_no_groups_of_their_own(spark):
    from vellum.plans import QUERIES

    for name in ("header_footnotes", "section_chunks", "sliding_windows", "older_rules"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan, name
