"""Line dedup against brute force: every pair of lines compared, components by a plain walk."""

import random

from vellum.llm import line_dedup as ld


def brute(rows: list[tuple], shortest: int = 1) -> dict:
    """doc_id -> text of what stays; rows: (doc_id, text), ids different and not null."""
    places: dict[str, list] = {}
    for d, t in sorted(rows):
        for no, x in enumerate((t or "").split("\n")):
            f = ld.folded(x)
            if len(f) >= shortest and f:
                places.setdefault(f, []).append((d, no))
    lines = list(places)
    part = list(range(len(lines)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    long = [i for i, x in enumerate(lines) if len(x) >= ld.MIN_CHARS]
    sets = {i: ld.shingles(lines[i]) for i in long}
    holders: dict[str, list] = {}
    for i in long:
        near: dict[int, int] = {}
        for s in sets[i]:
            for j in holders.get(s, ()):
                near[j] = near.get(j, 0) + 1
            holders.setdefault(s, []).append(i)
        for j, both in near.items():
            if both >= ld.THRESHOLD * (len(sets[i]) + len(sets[j]) - both):
                part[top(i)] = top(j)
    groups: dict[int, list] = {}
    for i, x in enumerate(lines):
        groups.setdefault(top(i), []).extend(places[x])
    gone = {p for g in groups.values() for p in sorted(g)[1:]}
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = None
            continue
        left = [x for no, x in enumerate(t.split("\n")) if (d, no) not in gone]
        if any(ld.folded(x) for x in left) or not any(ld.folded(x) for x in t.split("\n")):
            out[d] = "\n".join(left)
    return out


def near_copies(n: int, seed: int) -> list[tuple]:
    """One line with words changed at many rates, so that links are chains of near copies at all similarities."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "ame") for b in ("em", "um", "or", "et", "is", "an")]
    base = [r.choice(words) for _ in range(40)]
    out = []
    for i in range(n):
        rate = r.choice((0.0, 0.02, 0.05, 0.1))
        out.append((i, " ".join(r.choice(words) if r.random() < rate else w for w in base) + f"\nown line {i} of the document {i * i}"))
    return out


def test_near_copies_against_brute_force(spark):
    rows = near_copies(400, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in ld.report(df).collect()} == brute(rows)


def test_blocks_find_the_same_links(spark):
    from vellum.llm.shared import components, stored

    rows = [(i, "d", 0, t.split("\n")[0]) for i, t in near_copies(120, 9)]
    df = spark.createDataFrame([(a, 0, d) for a, _, _, d in rows], "doc_id long, th long, text string")

    def parts(**blocks) -> list:
        signatures = stored(ld._signatures(df, 1), "signatures")
        found: dict = {}
        for r in components(ld._edges(df, signatures, **blocks)).collect():
            found.setdefault(r.component, set()).add(r.node)
        return sorted(map(sorted, found.values()))

    assert parts() == parts(block_lines=16) == parts(block_chars=4_000)


def test_forest_against_all_pairs():
    lines = [ld.shingles(t.split("\n")[0]) for _, t in near_copies(150, 2)]

    def parts(links) -> list:
        part = list(range(len(lines)))
        for a, b in links:
            part = [part[a] if p == part[b] else p for p in part]
        return part

    every = [(i, j) for i in range(150) for j in range(i) if ld.jaccard(lines[i], lines[j]) >= ld.THRESHOLD]
    same = lambda p: sorted(sorted(i for i in range(150) if p[i] == g) for g in set(p))
    within = ld.forest(lines)
    assert same(parts(within)) == same(parts(every)) and len(within) == 150 - len(set(parts(every)))
    a, b = lines[:70], lines[70:]
    split = ld.forest(a) + [(i + 70, j + 70) for i, j in ld.forest(b)] + ld.forest(a, b)
    assert same(parts(split)) == same(parts(every))


def test_numbers_stand_for_shingles():
    lines = [t.split("\n")[0] for _, t in near_copies(20, 3)] + ["short", "x" * 40, "é\u4e00 ü" * 9]
    many = [*lines, "".join(map(chr, range(0x4E00, 0x4E00 + 300)))]
    for some in (lines, many):
        sets, numbers = [ld.shingles(x) for x in some], ld.shingle_numbers(some)
        assert [len(x) for x in numbers] == [len(x) for x in sets]
        for a, x in zip(numbers, sets):
            for b, y in zip(numbers, sets):
                assert len(set(a.tolist()) & set(b.tolist())) == len(x & y) and a.tolist() == sorted(set(a.tolist()))


def test_recall_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r.text for r in ld.report(docs).collect()}
    lines = lambda x: sum((t or "").count("\n") + 1 for t in x.values())
    assert got == want and lines(got) < sum((r.text or "").count("\n") + 1 for r in docs.collect())


def test_odd_rows(spark):
    long = "x y z " * 40_000
    rows = [
        (None, "a line of a row without any id, long enough\nsecond", {"a": 1}, 1, 2), (1, "A line of a row without any id, long  enough!", None, 1, 2), (2, long, {}, 1, 2), (3, long.upper(), None, 1, 2),
        (4, "twice the same row, and its line", {"b": 2}, 1, 2), (4, "twice the same row, and its line", {"a": 1}, 1, 2), (5, None, None, 1, 2), (6, "", None, 1, 2), (7, "é" * 30 + "\n" + "É" * 30, None, 1, 2),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone map<string,int>, row int, `a.b` int")
    got = ld.dedup_lines(df, shortest=1)
    assert got.columns == df.columns
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert texts == {(None, rows[0][1]), (2, long), (4, rows[4][1]), (5, None), (6, ""), (7, rows[8][1])} and got.count() == 6
    assert ld.dedup_lines(df.where("doc_id < 0")).count() == 0


def test_folding():
    for x in ("A \t b\r", "  ", "\x0b\x0cé Ü  ß ", "ABC", ""):
        assert ld.folded(x) == " ".join(p for p in x.translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if p)
