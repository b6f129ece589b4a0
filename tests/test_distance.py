"""Edit distances in words of bits, and the similarity of lines against its SQL."""

import random

import duckdb
import pytest

from vellum.functions import distance
from vellum.plans import QUERIES, SQL


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.mark.parametrize("words", [3, distance.WORDS])
def test_distances_equal_a_plain_table(monkeypatch, words):
    monkeypatch.setattr(distance, "WORDS", words)
    r = random.Random(7)
    text = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    a = [text(n, s) for n in (0, 1, 63, 64, 65, 130) for _ in range(6) for s in ("ab", "abcdefgh \x00\x7f")]
    b = [text(r.choice((0, 1, 2, 63, 64, 65, 128, 200)), s) for _ in range(36) for s in ("ab", "abcdefgh \x00\x7f")]
    near = [text(150, "abc") for _ in range(10)]
    a, b = a + near, b + [x[:40] + x[43:100] + "c" + x[100:] for x in near]
    assert distance.distances(a, b).tolist() == [plain(x, y) for x, y in zip(a, b)]


def test_long_lines():
    assert distance.distances(["ab" * 20_000, "x"], ["ba" * 20_000, "y" * 70_000]).tolist() == [2, 70_000]


def test_line_similarity_of_odd_lines_equals_its_sql(spark, tmp_path):
    """No step for each pair of characters, one distance of texts without spaces, not tabs, around."""
    texts = ["\tab\nab\n  ab \t\n \x0bab", "é ü\nè ü\n𝄞 x\n\x0c\n? x", "one\n\n\none \ntwo", "a" * 500 + "\n" + "b" + "a" * 500, "x  \nx ", "", "single", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["line_similarity"](spark, str(tmp_path))
    assert "levenshtein" not in df._jdf.queryExecution().toString()
    c = duckdb.connect()
    c.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, df.collect())) == sorted(c.sql(SQL["line_similarity"]).fetchall())
